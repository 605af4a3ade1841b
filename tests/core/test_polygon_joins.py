import random

import pytest

from sparkwharf.operators import polygon_joins as m
from tests.core.test_planar import KIND, inside, star

TRACK = "array<struct<lng: double, lat: double>>"


def points(ring):
    return None if ring is None else [{"lng": float(x), "lat": float(y)} for x, y in ring]


def crosses(a, b, c, d):
    side = lambda o, p, q: round(((p[0] - o[0]) * (q[1] - o[1]) - (p[1] - o[1]) * (q[0] - o[0])) * 1e12)
    on = lambda o, p, q: side(o, p, q) == 0 and min(o[0], p[0]) <= q[0] <= max(o[0], p[0]) and min(o[1], p[1]) <= q[1] <= max(o[1], p[1])
    return (side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0) or on(a, b, c) or on(a, b, d) or on(c, d, a) or on(c, d, b)


def brute(tracks, polygons):
    out = set()
    for t, way in tracks:
        for k, rings in polygons:
            if not way or not rings:
                continue
            edges = [e for r in rings for e in zip(r, r[1:] + r[:1], strict=True)]
            if sum(inside(r, *way[0]) for r in rings) % 2 or any(crosses(a, b, c, d) for a, b in (zip(way, way[1:]) if len(way) > 1 else [(way[0], way[0])]) for c, d in edges):
                out.add((t, k))
    return out


def found(spark, tracks, polygons, side=None):
    t = spark.createDataFrame([(t, points(w)) for t, w in tracks], f"t int, way {TRACK}").repartition(3)
    p = spark.createDataFrame([(k, None if r is None else [points(x) for x in r]) for k, r in polygons], f"k string, rings {KIND}")
    return {tuple(r) for r in m.meet(t, "t", "way", p, "k", "rings", side).collect()}


@pytest.mark.parametrize("seed, side", [(1, None), (2, 700), (3, 5_000_000)])
def test_against_brute_force(spark, seed, side):
    rng = random.Random(seed)
    spread = 0.02 if side == 700 else 2
    at = lambda: round(rng.uniform(-spread, spread), 6)
    polygons = [(f"p{i}", [star(rng, at(), at(), rng.randint(3, 9), rng.uniform(0.05, 1) * spread)]) for i in range(25)]
    polygons.append(("hole", [[(-spread, -spread), (spread, -spread), (spread, spread), (-spread, spread)], star(rng, 0, 0, 12, spread * 0.8)]))
    tracks = [(i, [(at(), at()) for _ in range(rng.randint(1, 4))]) for i in range(60)]
    assert found(spark, tracks, polygons, side) == brute(tracks, polygons)


def test_edges_belong_and_cases(spark):
    box = [(0, 0), (4, 0), (4, 4), (0, 4)]
    polygons = [("box", [box]), ("ring", [box, [(1, 1), (3, 1), (3, 3), (1, 3)]]), ("none", None), ("flat", [[(0, 0), (4, 4), (2, 2)]])]
    tracks = [(1, [(0, 2)]), (2, [(2, 2)]), (3, [(2, 2), (2, 1)]), (4, [(4, 4), (9, 9)]), (5, [(5, 0), (5, 5)]), (6, []), (7, None), (8, [(-1, 2), (9, 2)]), (2, [(2, 2)])]
    assert found(spark, tracks, polygons) == {(1, "box"), (1, "ring"), (2, "box"), (3, "box"), (3, "ring"), (4, "box"), (4, "ring"), (8, "box"), (8, "ring")}


def test_large_polygons_cost_their_edge(spark):
    """A box of 1,000 x 1,000 tiles is covered by a few blocks a column."""
    from sparkwharf.operators import planar

    layer = planar.segments(spark.createDataFrame([("k", [points([(0, 0), (1, 0), (1, 1), (0, 1)])])], f"k string, rings {KIND}"), "k", "rings")
    edge, inner = m.cover(layer, 1000)
    assert edge.count() < 9_000 and inner.count() < 1_000 * 55 and inner.filter("level = 2").count() > 1_000
    assert 997**2 <= inner.selectExpr("sum(pow(16, level))").first()[0] <= 1000**2


@pytest.mark.parametrize("low, high", [(3, 5), (0, 4096), (-5000, 70000), (17, 17), (15, 33)])
def test_blocks(spark, low, high):
    got = spark.range(1).selectExpr(f"inline({m.blocks(f'CAST({low} AS BIGINT)', f'CAST({high} AS BIGINT)')})").collect()
    assert sorted(t for r in got for t in range(r["block"] * 16 ** r["level"], (r["block"] + 1) * 16 ** r["level"])) == list(range(low, high))


def test_near_misses_are_told_from_hits(spark):
    """Tracks and points a ten-millionth of a degree off a slanting edge, less than a step of the unions' grid."""
    polygons = [("k", [[(0, 0), (3, 1), (3, 5), (0, 5)]])]
    off = 1e-7
    tracks = [(1, [(1.5, 0.5 - off)]), (2, [(1.5, 0.5 + off)]), (3, [(0.3, 0.1 - off), (2.7, 0.9 - off)]), (4, [(0.3, 0.1 - off), (2.7, 0.9 + off)])]
    assert found(spark, tracks, polygons) == {(2, "k"), (4, "k")}


def test_a_touched_corner_is_no_crossing(spark):
    t = spark.createDataFrame([(1, points([(0, 2), (2, 0)])), (2, points([(0, 1), (3, 1.5)]))], f"t int, way {TRACK}")
    p = spark.createDataFrame([("k", [points([(1, 1), (3, 1), (3, 3), (1, 3)])])], f"k string, rings {KIND}")
    met = lambda touching: {r.t for r in m.meet(t, "t", "way", p, "k", "rings", touching=touching).collect()}
    assert met(True) == {1, 2} and met(False) == {2}
