"""Simplification of polygons that keeps neighbours edge to edge and rings simple.

Rings are cut into arcs at nodes, the points where the layer's edges go more than two ways; a ring without nodes is cut at its
smallest point and at the one farthest from it. An arc that several rings share is simplified once (Douglas and Peucker), so
all of them get the same points. Each point carries the tolerance at which it goes. Then the segments that are left
are tried against each other in tiles: where two of a geometry (or, with ``together``, of the whole layer) cross, touch
or coincide, the tolerance of both arcs is quartered, in the end to none, and they are tried again.

Cases: shells and holes stay in their order, all rings keep three points or more; a key without polygons gives an empty array; null polygons give null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwharf.operators import planar
from sparkwharf.sources.shared import written

#: Rounds in which tolerances are quartered; conflicts after those get the arcs' own points.
ROUNDS = 6
_ARC = "array<struct<x: bigint, y: bigint>>"


def levels(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each point of a line the tolerance from which it is left out; the ends never are.

    A point's level is no higher than that of the point that split its stretch, so one threshold gives the whole result.
    """
    out, todo = np.full(len(x), np.inf), [(0, len(x) - 1, np.inf)]
    while todo:
        a, b, most = todo.pop()
        if b - a < 2:
            continue
        px, py = (x[a + 1 : b] - x[a]).astype(float), (y[a + 1 : b] - y[a]).astype(float)
        dx, dy = float(x[b] - x[a]), float(y[b] - y[a])
        length = dx * dx + dy * dy
        share = np.clip((px * dx + py * dy) / length, 0, 1) if length else np.zeros(b - a - 1)
        off = np.hypot(px - share * dx, py - share * dy)
        k = int(np.argmax(off))
        out[a + 1 + k] = level = min(most, float(off[k]))
        todo += [(a, a + 1 + k, level), (a + 1 + k, b, level)]
    return out


def arcs_of(points: list[tuple[int, int]], nodes: list[bool]) -> list[tuple[bool, list[tuple[int, int]]]]:
    """A ring's arcs in order, each in the direction that is smaller, with whether that is against the ring's."""
    n, cuts = len(points), [i for i, node in enumerate(nodes) if node]
    if not cuts:
        first = points.index(min(points))
        away = lambda i: (points[i][0] - points[first][0]) ** 2 + (points[i][1] - points[first][1]) ** 2
        cuts = sorted([first, max(range(n), key=lambda i: (away(i), points[i]))])
    out = []
    for a, b in zip(cuts, [*cuts[1:], cuts[0] + n], strict=True):
        way = [points[i % n] for i in range(a, b + 1)]
        out.append((way[::-1] < way, min(way, way[::-1])))
    return out


def _ring_arcs(rings: DataFrame) -> DataFrame:
    """``k, p, r, pos, back, arc, level`` of ``rings(k, p, r, points array<struct<x, y, node>>)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, pos, back, arcs, level = [], [], [], [], []
            for i, points in enumerate(batch.column("points").to_pylist()):
                for j, (flip, arc) in enumerate(arcs_of([(p["x"], p["y"]) for p in points], [p["node"] for p in points])):
                    xy = np.array(arc, np.int64)
                    rows.append(i)
                    pos.append(j)
                    back.append(flip)
                    arcs.append([{"x": x, "y": y} for x, y in arc])
                    level.append(levels(xy[:, 0], xy[:, 1]).tolist())
            same = batch.select(["k", "p", "r"]).take(pa.array(rows, pa.int64()))
            kind = pa.list_(pa.struct([("x", pa.int64()), ("y", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*same.columns, pa.array(pos, pa.int32()), pa.array(back, pa.bool_()), pa.array(arcs, kind), pa.array(level, pa.list_(pa.float64()))], ["k", "p", "r", "pos", "back", "arc", "level"])

    return rings.mapInArrow(run, f"k {rings.schema['k'].dataType.simpleString()}, p int, r int, pos int, back boolean, arc {_ARC}, level array<double>")


def _conflicts(arcs: DataFrame, of: DataFrame, side: int) -> DataFrame:
    """``id`` of arcs of which a segment that is left meets another of its group ``g`` elsewhere than in shared ends."""
    kept = arcs.select("id", F.expr("filter(arrays_zip(arc, level), z -> z.level > tolerance).arc AS arc"))
    pairs = kept.select("id", F.inline(F.expr("zip_with(slice(arc, 1, size(arc) - 1), slice(arc, 2, size(arc) - 1), (p, q) -> struct(least(p, q) AS a, greatest(p, q) AS b))")))
    s = of.select("g", "id").distinct().join(pairs, "id").selectExpr("g AS k", "id", "a.x AS ax", "a.y AS ay", "b.x AS bx", "b.y AS by")
    tiled = planar.listed(s, side)
    other = tiled.selectExpr("k", "tx", "ty", "id AS other", "ax AS cx", "ay AS cy", "bx AS dx", "by AS dy")
    t, on = planar.turn, planar.lies_on
    ends = lambda p, q: f"({p}x = {q}x AND {p}y = {q}y)"
    crossing = f"sign({t('a', 'b', 'c')}) * sign({t('a', 'b', 'd')}) < 0 AND sign({t('c', 'd', 'a')}) * sign({t('c', 'd', 'b')}) < 0"
    touching = " OR ".join(f"({on(o, p, q)} AND NOT {ends(o, q)} AND NOT {ends(p, q)})" for o, p, q in (("a", "b", "c"), ("a", "b", "d"), ("c", "d", "a"), ("c", "d", "b")))
    same = f"({ends('a', 'c')} AND {ends('b', 'd')} AND id <> other)"
    first = "(struct(id, ax, ay, bx, by) < struct(other, cx, cy, dx, dy))"
    met = tiled.join(other, ["k", "tx", "ty"]).filter(f"{first} AND ({crossing} OR {touching} OR {same})")
    return met.select(F.explode(F.array("id", "other")).alias("id")).distinct()


def simplify(polygons: DataFrame, key: str, shapes: str, tolerance: float, together: bool = False) -> DataFrame:
    """``polygons`` with the open rings of ``shapes`` (array<array<array<struct<lng, lat>>>>, one row a key) simplified.

    ``together``: the keys' polygons don't overlap and must not come to; otherwise each key is looked at alone.
    """
    at = lambda p: F.struct(planar.snapped(p["lng"]).alias("x"), planar.snapped(p["lat"]).alias("y"))
    rings = polygons.select(F.col(key).alias("k"), F.posexplode(shapes).alias("p", "rings")).select("k", "p", F.posexplode("rings").alias("r", "ring"))
    rings = written(rings.select("k", "p", "r", F.transform("ring", at).alias("ring")), "rings")
    # an edge once, whoever has it; a node is where other than two end
    n = F.size("ring")
    edges = rings.select(F.explode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get("ring", i).alias("p"), F.get("ring", (i + 1) % n).alias("q")))).alias("e"))
    ends = edges.select(F.inline(F.array(F.struct(F.col("e.p").alias("v"), F.col("e.q").alias("w")), F.struct(F.col("e.q").alias("v"), F.col("e.p").alias("w"))))).distinct()
    nodes = ends.groupBy("v").agg(F.count(F.lit(1)).alias("ways")).filter("ways <> 2").select("v", F.lit(True).alias("node"))
    points = rings.select("k", "p", "r", F.posexplode("ring").alias("i", "v")).join(nodes, "v", "left")
    marked = points.groupBy("k", "p", "r").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v.x", "v.y", F.coalesce("node", F.lit(False)).alias("node")))), lambda z: F.struct(z["x"], z["y"], z["node"])).alias("points"))
    of = written(_ring_arcs(marked).withColumn("id", F.sha2(F.to_json("arc"), 256)).withColumn("g", F.lit(0) if together else F.col("k")), "ring_arcs")
    arcs = of.groupBy("id").agg(F.first("arc").alias("arc"), F.first("level").alias("level")).withColumn("tolerance", F.lit(tolerance / planar.UNIT))
    arcs = written(arcs, "arcs")
    side = planar.tile_side(edges.selectExpr("least(e.p.x, e.q.x) AS ax", "greatest(e.p.x, e.q.x) AS bx", "e.p.y AS ay", "e.q.y AS by")) * 2
    for turn in range(ROUNDS + 2):
        bad = written(_conflicts(arcs, of, side).join(arcs.filter("tolerance >= 0").select("id"), "id", "left_semi"), "conflicts")
        if bad.isEmpty():
            break
        less = F.col("tolerance") / 4 if turn < ROUNDS else F.lit(-1.0)
        arcs = written(arcs.join(bad.withColumn("bad", F.lit(True)), "id", "left").withColumn("tolerance", F.when(F.col("bad"), less).otherwise(F.col("tolerance"))).drop("bad"), "arcs")
    left = arcs.select("id", F.expr("filter(arrays_zip(arc, level), z -> z.level > tolerance).arc AS left"))
    way = F.when(F.col("back"), F.reverse("left")).otherwise(F.col("left"))
    degrees = lambda p: F.struct(F.round(p["x"] * planar.UNIT, 6).alias("lng"), F.round(p["y"] * planar.UNIT, 6).alias("lat"))
    parts = of.select("k", "p", "r", "pos", "back", "id").join(left, "id").select("k", "p", "r", "pos", F.transform(way, degrees).alias("way"))
    ordered = lambda *c: F.array_sort(F.collect_list(F.struct(*c)))
    # an arc's last point is the next one's first
    made = parts.groupBy("k", "p", "r").agg(F.flatten(F.transform(ordered("pos", "way"), lambda z: F.slice(z["way"], 1, F.size(z["way"]) - 1))).alias("ring"))
    made = made.groupBy("k", "p").agg(F.transform(ordered("r", "ring"), lambda z: z["ring"]).alias("rings"))
    made = made.groupBy("k").agg(F.transform(ordered("p", "rings"), lambda z: z["rings"]).alias("_made"))
    empty = F.when(F.col(shapes).isNotNull(), F.array().cast(polygons.schema[shapes].dataType))
    return polygons.join(made.withColumnRenamed("k", "_k"), F.col(key) == F.col("_k"), "left").withColumn(shapes, F.coalesce(F.col("_made"), empty)).drop("_k", "_made")
