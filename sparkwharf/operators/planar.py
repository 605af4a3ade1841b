"""Overlays in the plane as joins and sums: unions of free polygons with holes, and the outlines they have.

Coordinates are whole numbers of ``UNIT`` degrees, so every test of sides is exact. A layer is a table of segments ``k, ax, ay, bx, by, w``:
``k`` the geometry it belongs to, the ends in order of x, then y, and ``w`` how often it runs from the first end to the
second less how often it runs back. Segments that neighbours share cancel in one combining sum, before anything else is done.

* Segments are listed under the square tiles that they cross. The tile's side is twice the mean extent, so all segments
  together have a few listings each, however long some are.
* Crossings are found in tiles and rounded to the grid. Every segment then runs through all ends and crossings whose unit square it touches
  (snap rounding: Hobby, "Practical segment intersection with finite precision output"; Guibas and Marimont, "Rounding
  arrangements dynamically"), after which segments meet at ends only.
* The winding number beside a segment is that of its tile's corner, from a running sum up the column of tiles, and the
  crossings on the way from the corner, from a join in the tile. Segments between winding 0 or less and more are the outline.

Unions begin in rounds: neighbours of a key are united within tasks, a few at a time (:mod:`overlay`), and the tiles get only the outlines that no round joins.
Only the outline of one geometry meets in a task, where it becomes one value anyway.

Cases: rings may be closed or open, run either way and repeat points; the first ring of a polygon is its shell, the others holes; rings without area are ignored;
where a ring crosses itself the area that it winds round against its own sense is left out; null keys and rings take no part.
"""

from __future__ import annotations

from functools import cmp_to_key

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwharf.operators import overlay
from sparkwharf.sources.shared import written

#: Degrees of a grid step, about 0.1 m: coordinates of the globe keep all products below 2^63.
UNIT = 1e-6
#: A step far below what two places of a table lie apart, about as fine as degrees are as doubles; products of such coordinates pass 2^63, see :func:`cross`.
FINE = 1e-12
Point = tuple[int, int]
_SEGMENT = ["k", "ax", "ay", "bx", "by"]


def snapped(degrees: Column, unit: float = UNIT) -> Column:
    return F.round(degrees / unit).cast("long")


def cross(u: str, v: str, s: str, t: str, fine: bool = False) -> str:
    """SQL of ``u * v - s * t``; with ``fine`` only its sign, exactly: in doubles where their errors can't change it, else in decimals."""
    if not fine:
        return f"({u} * {v} - {s} * {t})"
    a, b = f"CAST({u} AS DOUBLE) * {v}", f"CAST({s} AS DOUBLE) * {t}"
    whole = lambda x: f"CAST({x} AS DECIMAL(18, 0))"
    return f"IF(abs({a} - {b}) > 1e-15 * (abs({a}) + abs({b})), sign({a} - {b}), sign({whole(u)} * {whole(v)} - {whole(s)} * {whole(t)}))"


def _netted(directed: DataFrame) -> DataFrame:
    """Segments ``k, px, py, qx, qy, n`` in the order of their ends, summed; what cancels goes."""
    ahead = (F.col("px") < F.col("qx")) | ((F.col("px") == F.col("qx")) & (F.col("py") < F.col("qy")))
    ends = [F.when(ahead, F.col(a)).otherwise(F.col(b)).alias(c) for c, a, b in (("ax", "px", "qx"), ("ay", "py", "qy"), ("bx", "qx", "px"), ("by", "qy", "py"))]
    once = directed.filter("px <> qx OR py <> qy").select("k", *ends, F.when(ahead, F.col("n")).otherwise(-F.col("n")).alias("n"))
    return once.groupBy(*_SEGMENT).agg(F.sum("n").cast("long").alias("w")).filter("w <> 0")


def segments(polygons: DataFrame, key: str, rings: str, unit: float = UNIT) -> DataFrame:
    """The layer of ``polygons``; ``rings`` is array<array<struct<lng, lat>>>, shells counted against the clock and holes with it."""
    at = lambda p: F.struct(snapped(p["lng"], unit).alias("x"), snapped(p["lat"], unit).alias("y"))
    one = polygons.select(F.col(key).alias("k"), F.posexplode(rings).alias("hole", "ring")).dropna().withColumn("ring", F.transform("ring", at))
    # from the first point, so that products stay small
    kind, whole = ("DOUBLE", lambda x: f"({x})") if unit == UNIT else ("DECIMAL(38, 0)", lambda x: f"CAST({x} AS DECIMAL(18, 0))")
    part = f"{whole('p.x - ring[0].x')} * {whole('q.y - ring[0].y')} - {whole('q.x - ring[0].x')} * {whole('p.y - ring[0].y')}"
    twice = f"aggregate(zip_with(ring, slice(concat(ring, array(ring[0])), 2, size(ring)), (p, q) -> {part}), CAST(0 AS {kind}), (s, v) -> CAST(s + v AS {kind}))"
    one = one.filter("size(ring) > 2").withColumn("area", F.expr(twice)).filter("area <> 0")
    sense = F.when((F.col("area") > 0) == (F.col("hole") == 0), 1).otherwise(-1)
    pairs = F.expr("zip_with(ring, slice(concat(ring, array(ring[0])), 2, size(ring)), (p, q) -> struct(p.x AS px, p.y AS py, q.x AS qx, q.y AS qy))")
    return _netted(one.select("k", sense.alias("n"), F.inline(pairs)))


def tile_side(layer: DataFrame) -> int:
    """Twice the mean extent of the layer's segments."""
    mean = layer.agg(F.avg(F.greatest(F.col("bx") - F.col("ax"), F.abs(F.col("by") - F.col("ay"))))).first()[0]
    return max(16, int(2 * (mean or 0)))


def listed(layer: DataFrame, side: int) -> DataFrame:
    """A row for each tile ``tx, ty`` that a segment crosses or comes within two steps of."""
    y = lambda x, upright: f"IF(bx = ax, {upright}, ay + (by - ay) * ((least(bx, greatest(ax, {x})) - ax) / (bx - ax)))"
    y0, y1 = y(f"tx * {side} - 2", "ay"), y(f"(tx + 1) * {side} + 2", "by")
    rows = f"sequence(floor((least({y0}, {y1}) - 2) / {side}), floor((greatest({y0}, {y1}) + 2) / {side}))"
    tiles = f"flatten(transform(sequence(floor((ax - 2) / {side}), floor((bx + 2) / {side})), tx -> transform({rows}, ty -> struct(tx, ty))))"
    return layer.select("*", F.inline(F.expr(tiles)))


def turn(o: str, p: str, q: str, fine: bool = False) -> str:
    """Over 0 if q is left of the way from o to p."""
    return cross(f"({p}x - {o}x)", f"({q}y - {o}y)", f"({p}y - {o}y)", f"({q}x - {o}x)", fine)


def lies_on(o: str, p: str, q: str) -> str:
    """Whether q is on the segment from o to p, ends included."""
    return f"({q}x BETWEEN least({o}x, {p}x) AND greatest({o}x, {p}x) AND {q}y BETWEEN least({o}y, {p}y) AND greatest({o}y, {p}y) AND {turn(o, p, q)} = 0)"


def crossings(tiled: DataFrame) -> DataFrame:
    """``k, x, y``: the grid points nearest to where two segments of a geometry cross, each inside the other."""
    s = tiled.select(*_SEGMENT, "tx", "ty")
    t = s.select("k", *[F.col(c).alias({"a": "c", "b": "d"}[c[0]] + c[1]) for c in _SEGMENT[1:]], "tx", "ty")
    abc, abd, cda, cdb = turn("a", "b", "c"), turn("a", "b", "d"), turn("c", "d", "a"), turn("c", "d", "b")
    apart = f"sign({abc}) * sign({abd}) < 0 AND sign({cda}) * sign({cdb}) < 0"
    met = s.join(t, ["k", "tx", "ty"]).filter(f"struct(ax, ay, bx, by) < struct(cx, cy, dx, dy) AND {apart}")
    share = f"try_divide(CAST({cda} AS DOUBLE), CAST({cda} AS DOUBLE) - {cdb})"  # shared parts of plans may be worked out before their filter
    return met.select("k", F.expr(f"CAST(round(ax + (bx - ax) * {share}) AS BIGINT) AS x"), F.expr(f"CAST(round(ay + (by - ay) * {share}) AS BIGINT) AS y")).distinct()


def noded(layer: DataFrame, side: int) -> DataFrame:
    """The layer with its segments cut, so that they meet at ends only."""
    tiled = listed(layer, side)
    ends = layer.select("k", F.inline(F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")))))
    points = ends.union(crossings(tiled)).distinct().withColumns({"tx": F.floor(F.col("x") / side), "ty": F.floor(F.col("y") / side)})
    inside = "x BETWEEN ax AND bx AND y BETWEEN least(ay, by) AND greatest(ay, by)"
    near = "2 * abs((bx - ax) * (y - ay) - (by - ay) * (x - ax)) <= (bx - ax) + abs(by - ay)"
    met = tiled.join(points, ["k", "tx", "ty"]).filter(f"{inside} AND {near}")
    along = F.expr("(x - ax) * (bx - ax) + (y - ay) * (by - ay)")
    way = Window.partitionBy(*_SEGMENT).orderBy(along, "x", "y")
    cut = met.select("k", F.col("x").alias("px"), F.col("y").alias("py"), F.lead("x").over(way).alias("qx"), F.lead("y").over(way).alias("qy"), F.col("w").alias("n"))
    return _netted(cut.filter("qx IS NOT NULL"))


def _beside(a: str, b: str, px: str, py: str, fine: bool = False) -> str:
    """Over 0 if p is left of the way from a to b; p is doubled, a and b are not."""
    return cross(f"(2 * {b}x - 2 * {a}x)", f"({py} - 2 * {a}y)", f"(2 * {b}y - 2 * {a}y)", f"({px} - 2 * {a}x)", fine)


def others(tiled: DataFrame) -> DataFrame:
    """Listed segments under the names ``cx, cy, dx, dy, n``, to be met by points or other segments of their tiles."""
    return tiled.select("k", "tx", "ty", *[F.col(c).alias({"a": "c", "b": "d"}[c[0]] + c[1]) for c in _SEGMENT[1:]], F.col("w").alias("n"))


def _corner(side: int) -> tuple[str, str]:
    """A tile's first corner, doubled: half a step off the grid, so that no end of a segment is on a border."""
    return f"(2 * tx * {side} - 1)", f"(2 * ty * {side} - 1)"


def passes(side: int, fine: bool = False) -> str:
    """Whether a listed segment crosses the border of its tile that leads up from the first corner."""
    x, y = _corner(side)
    over = lambda y: f"({_beside('a', 'b', x, y, fine)} > 0 OR ({_beside('a', 'b', x, y, fine)} = 0 AND by < ay))"
    return f"2 * ax < {x} AND {x} < 2 * bx AND NOT {over(y)} AND {over(f'(2 * (ty + 1) * {side} - 1)')}"


def from_corner(mx: str, my: str, side: int, fine: bool = False) -> str:
    """What a segment of :func:`others` adds to the winding number from the tile's first corner to the doubled point (mx, my).

    The way leads along the tile's foot, then up. Points count as a hair to the right of where they are.
    """
    x, y = _corner(side)
    low, high = ("IF(cy < dy, cx, dx)", "least(cy, dy)"), ("IF(cy < dy, dx, cx)", "greatest(cy, dy)")
    upward = lambda px, py: cross(f"(2 * {high[0]} - 2 * {low[0]})", f"({py} - 2 * {low[1]})", f"(2 * {high[1]} - 2 * {low[1]})", f"({px} - 2 * {low[0]})", fine)
    flat = f"((2 * cy < {y}) <> (2 * dy < {y}) AND {upward(x, y)} > 0 AND {upward(mx, y)} <= 0)"
    foot = _beside("c", "d", mx, y, fine)
    steep = f"(2 * cx <= {mx} AND {mx} < 2 * dx AND ({foot} < 0 OR ({foot} = 0 AND dy > cy)) AND {_beside('c', 'd', mx, my, fine)} > 0)"
    return f"IF({flat}, IF(cy < dy, -n, n), 0) + IF({steep}, n, 0)"


def outline(net: DataFrame, side: int) -> DataFrame:
    """``k, px, py, qx, qy``: the segments of a noded layer between winding over 0 and the rest, the area to their left.

    Where a segment runs through a corner or below a middle exactly, the point counts as a hair to the right of it, at every step alike.
    """
    tiled = listed(net, side)
    steps = tiled.filter(passes(side)).select("k", "tx", (F.col("ty") + 1).alias("ty"), F.col("w").alias("n"), F.lit(False).alias("asked"))

    middle = [F.floor((F.col("ax") + F.col("bx") + 1) / (2 * side)).alias("tx"), F.floor((F.col("ay") + F.col("by")) / (2 * side)).alias("ty")]
    asked = net.select("*", *middle)
    every = steps.union(asked.select("k", "tx", "ty", F.lit(0).cast("long"), F.lit(True))).groupBy("k", "tx", "ty").agg(F.sum("n").alias("n"), F.bool_or("asked").alias("asked"))
    column = Window.partitionBy("k", "tx").orderBy("ty").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    corners = every.withColumn("at_corner", F.sum("n").over(column)).filter("asked").select("k", "tx", "ty", "at_corner")

    way = F.expr(from_corner("(ax + bx)", "(ay + by)", side))
    local = asked.join(others(tiled), ["k", "tx", "ty"]).groupBy(*_SEGMENT, "w", "tx", "ty").agg(F.sum(way).alias("way"))
    # to the right of an upright segment, below any other; w more on its other side, which is left of the way from a to b
    both = local.join(corners, ["k", "tx", "ty"]).withColumn("right", F.col("at_corner") + F.col("way")).withColumn("left", F.col("right") + F.col("w"))
    kept, ahead = both.filter("(left > 0) <> (right > 0)"), F.col("left") > 0
    return kept.select("k", *[F.when(ahead, F.col(a)).otherwise(F.col(b)).alias(c) for c, a, b in (("px", "ax", "bx"), ("py", "ay", "by"), ("qx", "bx", "ax"), ("qy", "by", "ay"))])


def _by_angle(u: Point, v: Point) -> int:
    """The order of directions against the clock, from the east."""
    half = lambda d: 0 if d[1] > 0 or (d[1] == 0 and d[0] > 0) else 1
    return half(u) - half(v) or (u[1] * v[0] > u[0] * v[1]) - (u[1] * v[0] < u[0] * v[1])


def rings_of(edges: list[tuple[Point, Point]]) -> list[list[Point]]:
    """Simple rings with the area to their left. At a point where several meet, the way goes on along the same area."""
    out: dict[Point, list[Point]] = {}
    for a, b in edges:
        out.setdefault(a, []).append(b)
    following = {}
    for a, b in edges:
        ends = out[b]
        if len(ends) == 1:
            following[a, b] = ends[0]
            continue
        back = (a[0] - b[0], a[1] - b[1])
        # with the clock from the way back: the last one before it against the clock
        ranked = sorted([(back, None), *(((c[0] - b[0], c[1] - b[1]), c) for c in ends)], key=cmp_to_key(lambda u, v: _by_angle(u[0], v[0])))
        following[a, b] = ranked[[c for _, c in ranked].index(None) - 1][1]
    rings, left = [], dict.fromkeys(sorted(edges))
    while left:
        a, b = next(iter(left))
        way, place = [a], {a: 0}
        while True:
            del left[a, b]
            if b in place:
                rings.append(way[place[b] :])
                for p in way[place[b] + 1 :]:
                    del place[p]
                way = way[: place[b] + 1]
            else:
                place[b] = len(way)
                way.append(b)
            if (step := (b, following[a, b])) not in left:
                break
            a, b = step
    return rings


def area2(ring: list[Point]) -> int:
    return sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1], strict=True))


def _corners(ring: list[Point]) -> list[Point]:
    """Without points on a straight line, from the smallest corner on."""
    turns = [q for p, q, r in zip(ring[-1:] + ring[:-1], ring, ring[1:] + ring[:1], strict=True) if (q[0] - p[0]) * (r[1] - q[1]) != (q[1] - p[1]) * (r[0] - q[0])]
    first = turns.index(min(turns))
    return turns[first:] + turns[:first]


def _holds(ring: list[Point], x: int, y: int) -> bool:
    """Whether a doubled point that is on no edge lies in the ring."""
    inside = False
    for (px, py), (qx, qy) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (2 * py > y) != (2 * qy > y):
            turn = (2 * qx - 2 * px) * (y - 2 * py) - (2 * qy - 2 * py) * (x - 2 * px)
            inside ^= (turn > 0) == (qy > py)
    return inside


def polygons_of(edges: list[tuple[Point, Point]]) -> list[list[list[Point]]]:
    """Polygons, each a shell against the clock and its holes, in order."""
    shells, holes = [], []
    for ring in rings_of(edges):
        (shells if area2(ring) > 0 else holes).append(ring)
    shells.sort(key=lambda r: (area2(r), min(r)))
    inside: list[list[list[Point]]] = [[] for _ in shells]
    for hole in holes:
        (px, py), (qx, qy) = hole[0], hole[1]
        inside[next(i for i, shell in enumerate(shells) if _holds(shell, px + qx, py + qy))].append(_corners(hole))
    return sorted([_corners(shell), *sorted(own)] for shell, own in zip(shells, inside, strict=True))


def _row(kind: str) -> str:
    return f"k {kind}, done boolean, size long, strip long, y long, x long, ways array<struct<px: bigint, py: bigint, qx: bigint, qy: bigint>>"


def _ways(polygons: DataFrame, key: str, rings: str) -> DataFrame:
    """Each polygon as directed segments in ``ways``, its area to the left of them, with its size and place."""
    one = polygons.select(F.col(key).alias("k"), F.col(rings).alias("rings")).dropna()
    return one.mapInArrow(lambda batches: overlay.way_batches(batches, UNIT), _row(dict(one.dtypes)["k"]))


def _round(rows: DataFrame) -> DataFrame:
    """Neighbours of a key become one: polygons of like size and place are put side by side and united in groups of a bounded size within tasks."""
    order, n = ["k", "size", "strip", "y", "x"], int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    side_by_side = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("k", "ways")
    return written(side_by_side.mapInArrow(overlay.united_batches, _row(dict(rows.dtypes)["k"])), "united")


def union_layer(polygons: DataFrame, key: str, rings: str, side: int | None = None) -> DataFrame:
    """``k, px, py, qx, qy``: the outline of the union of each key's polygons, as :func:`outline` gives it.

    Groups of a key's neighbours are united first, and the outlines of groups again, so that crossings are found between a few areas at a time however many
    lie over each other. Keys of one outline are done. When rounds no longer halve the rest, it meets in tiles. With ``side`` all
    meets at once, in tiles of that side.
    """
    if side:
        layer = written(segments(polygons, key, rings), "layer")
        return outline(written(noded(layer, side), "noded"), side)
    rest, n, done = _ways(polygons, key, rings), None, None
    while True:
        rows = _round(rest)
        left = rows.filter("NOT done")
        several = written(left.groupBy("k").count().filter("count > 1").select("k"), "several")
        own = rows.filter("done").union(left.join(several, "k", "left_anti").select(*rows.columns))
        done = own if done is None else done.union(own)
        rest, before = left.join(several, "k", "left_semi").select(*rows.columns), n
        n = rest.count()
        if not n:
            return done.select("k", F.inline("ways"))
        if before and 2 * n > before:
            break
    layer = written(_netted(rest.select("k", F.lit(1).alias("n"), F.inline("ways"))), "layer")
    side = tile_side(layer)
    return done.select("k", F.inline("ways")).union(outline(written(noded(layer, side), "noded"), side))


def assembled(edges: DataFrame, key: str, kind: str) -> DataFrame:
    """``key, polygons``: array of polygons, each an array of open rings of struct<lng, lat>."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ways = list(zip(zip(rows["px"].tolist(), rows["py"].tolist(), strict=True), zip(rows["qx"].tolist(), rows["qy"].tolist(), strict=True), strict=True))
        made = [[[{"lng": round(x * UNIT, 6), "lat": round(y * UNIT, 6)} for x, y in ring] for ring in rings] for rings in polygons_of(ways)]
        return pd.DataFrame({key: [rows["k"].iloc[0]], "polygons": [made]})

    return edges.groupBy("k").applyInPandas(run, f"`{key}` {kind}, polygons array<array<array<struct<lng: double, lat: double>>>>")


def union(polygons: DataFrame, key: str, rings: str, side: int | None = None) -> DataFrame:
    """``key, polygons`` of the union of each key's polygons; a key whose polygons have no area isn't there."""
    return assembled(union_layer(polygons, key, rings, side), key, dict(polygons.dtypes)[key])


def multipolygon(polygons: Column) -> Column:
    """GeoJSON of what :func:`union` gives."""
    ring = lambda r: F.transform(F.concat(r, F.slice(r, 1, 1)), lambda p: F.array(p["lng"], p["lat"]))
    return F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.transform(polygons, lambda p: F.transform(p, ring)).alias("coordinates")))
