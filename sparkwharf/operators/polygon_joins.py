"""Joins of tracks and points with polygons: cells that lie inside a polygon accept at once, cells on its edge by exact tests.

A polygon is covered by square tiles. Those that its edges cross hold the edges; the runs of tiles between them, column by column, are inside
or outside as a whole, and the inner ones are stored as blocks of 1, 16, 256 or 4096 tiles, so a large polygon costs about as many rows
as its edge has tiles. A track looks its tiles up in both.

A track meets a polygon if it crosses or touches its edge or begins inside it. Coordinates are rounded to
``planar.FINE``, which moves none across an edge that it isn't on, all tests are exact on the rounded values, and edges belong to their polygon.

Cases: a track of one point is a point; empty and null tracks, null rings and rings without area meet nothing; repeated tracks
and polygons of one key are one; holes are outside, their edges are not.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkwharf.operators import planar
from sparkwharf.sources.shared import written

#: Tiles in a block of the next size; sizes of blocks.
STEP, LEVELS = 16, 4
#: More than what doubles can be off in a product of coordinates of the globe in steps of ``planar.FINE``.
DOUBT = 1e15


def blocks(low: str, high: str) -> str:
    """SQL of array<struct<level, block>> for the tiles from ``low`` up to but without ``high``: each level's blocks that no larger one covers."""
    up = lambda level: (f"CEIL({low} / {STEP**level})", f"FLOOR({high} / {STEP**level})")
    made = []
    for level in range(LEVELS):
        (a, b), (c, d) = up(level), up(level + 1)
        between = lambda x, y: f"IF({x} < {y}, sequence({x}, {y} - 1), CAST(array() AS ARRAY<BIGINT>))"
        own = between(a, b)
        if level + 1 < LEVELS:
            own = f"IF({c} < {d}, concat({between(a, f'{STEP} * {c}')}, {between(f'{STEP} * {d}', b)}), {own})"
        made.append(f"transform({own}, b -> struct({level} AS level, b AS block))")
    return f"concat({', '.join(made)})"


def cover(layer: DataFrame, side: int, fine: bool = False) -> tuple[DataFrame, DataFrame]:
    """Edge tiles ``k, tx, ty, at_corner`` with the winding number at their first corner; inner blocks ``k, tx, level, block``."""
    tiles = planar.listed(layer, side).groupBy("k", "tx", "ty").agg(F.sum(F.expr(f"IF({planar.passes(side, fine)}, w, 0)")).alias("up"))
    column = Window.partitionBy("k", "tx").orderBy("ty")
    after = F.sum("up").over(column.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = tiles.withColumns({"after": after, "next": F.lead("ty").over(column)})
    inner = runs.filter("after > 0 AND next > ty + 1").select("k", "tx", F.inline(F.expr(blocks("(ty + 1)", "next"))))
    return runs.select("k", "tx", "ty", (F.col("after") - F.col("up")).alias("at_corner")), inner


def track_segments(tracks: DataFrame, key: str, points: str) -> DataFrame:
    """``t, ax, ay, bx, by, px, py``: the segments of array<struct<lng, lat>> in order of their ends, and where the track begins; a point is a segment without length."""
    at = lambda p: F.struct(planar.snapped(p["lng"], planar.FINE).alias("x"), planar.snapped(p["lat"], planar.FINE).alias("y"))
    one = tracks.select(F.col(key).alias("t"), F.transform(points, at).alias("way")).dropna().filter("size(way) > 0")
    pairs = "IF(size(way) = 1, array(struct(way[0] AS a, way[0] AS b)), zip_with(slice(way, 1, size(way) - 1), slice(way, 2, size(way) - 1), (p, q) -> struct(least(p, q) AS a, greatest(p, q) AS b)))"
    return one.select("t", F.inline(F.expr(pairs)), F.expr("way[0]").alias("p")).selectExpr("t", "a.x AS ax", "a.y AS ay", "b.x AS bx", "b.y AS by", "p.x AS px", "p.y AS py").distinct()


def meet(tracks: DataFrame, track_key: str, points: str, polygons: DataFrame, key: str, rings: str, side: int | None = None, touching: bool = True) -> DataFrame:
    """Distinct ``track_key, key`` of the tracks and polygons that have a point in common; ``side`` of the tiles in ``planar.UNIT``. Without ``touching`` a track must cross an edge or begin inside."""
    layer = written(planar.segments(polygons, key, rings, planar.FINE), "polygons")
    side = side * round(planar.UNIT / planar.FINE) if side else planar.tile_side(layer)
    edge_tiles, inner = cover(layer, side, True)
    edges = planar.others(planar.listed(layer, side))
    tracked = written(planar.listed(track_segments(tracks, track_key, points), side), "tracks")

    at = F.array(*[F.struct(F.lit(level).alias("level"), F.floor(F.col("ty") / STEP**level).alias("block")) for level in range(LEVELS)])
    looked = tracked.select("t", "tx", "ty").distinct().select("t", "tx", F.inline(at))
    accepted = looked.join(inner, ["tx", "level", "block"]).select("t", "k")

    # segments have a point in common if their boxes have and neither is all on one side of the other
    boxes = "ax <= dx AND cx <= bx AND least(ay, by) <= greatest(cy, dy) AND least(cy, dy) <= greatest(ay, by)"
    about = lambda o, p, q: f"(CAST({p}x - {o}x AS DOUBLE) * ({q}y - {o}y) - CAST({p}y - {o}y AS DOUBLE) * ({q}x - {o}x))"
    maybe = lambda o, p, q, r: f"least({about(o, p, q)}, {about(o, p, r)}) <= {DOUBT} AND greatest({about(o, p, q)}, {about(o, p, r)}) >= -{DOUBT}"
    # few pairs are left by short tests in doubles; written, so that Spark doesn't pull the long exact ones into the join
    pairs = tracked.join(edges, ["tx", "ty"]).filter(f"{boxes} AND {maybe('a', 'b', 'c', 'd')} AND {maybe('c', 'd', 'a', 'b')}")
    pairs = written(pairs.select("t", "k", *[f"{p}{c}" for p in "abcd" for c in "xy"]), "crossings")
    turn = partial(planar.turn, fine=True)
    least = "<= 0" if touching else "< 0"
    crossed = pairs.filter(f"{turn('a', 'b', 'c')} * {turn('a', 'b', 'd')} {least} AND {turn('c', 'd', 'a')} * {turn('c', 'd', 'b')} {least}").select("t", "k")

    begins = tracked.filter(f"tx = FLOOR(px / {side}) AND ty = FLOOR(py / {side})").select("t", "px", "py", "tx", "ty").distinct()
    local = begins.join(edges, ["tx", "ty"]).groupBy("t", "px", "py", "tx", "ty", "k").agg(F.sum(F.expr(planar.from_corner("(2 * px)", "(2 * py)", side, True))).alias("way"))
    inside = local.join(edge_tiles, ["k", "tx", "ty"]).filter("at_corner + way > 0").select("t", "k")
    return accepted.union(crossed).union(inside).distinct().select(F.col("t").alias(track_key), F.col("k").alias(key))
