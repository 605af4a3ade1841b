import math
import random

import pytest
from pyspark.sql import functions as F

from sparkwharf.operators import planar as m

KIND = "array<array<struct<lng: double, lat: double>>>"


def area2(ring):
    return sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1], strict=True))


def inside(ring, x, y):
    return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) % 2 == 1


def union(spark, polygons, **more):
    """``{key: polygons}`` of (key, rings)."""
    df = spark.createDataFrame([(k, [[{"lng": float(x), "lat": float(y)} for x, y in ring] for ring in rings] if rings else None) for k, rings in polygons], f"alert string, rings {KIND}")
    return {r["alert"]: [[[(p["lng"], p["lat"]) for p in ring] for ring in polygon] for polygon in r["polygons"]] for r in m.union(df.repartition(3), "alert", "rings", **more).collect()}


def check_shape(polygons):
    """Shells against the clock, holes with it; no two edges cross or overlap; total area."""
    edges = [(a, b) for rings in polygons for ring in rings for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]
    assert len({frozenset(e) for e in edges}) == len(edges)
    whole = lambda p: (round(p[0] / m.UNIT), round(p[1] / m.UNIT))
    side = lambda o, p, q: (p[0] - o[0]) * (q[1] - o[1]) - (p[1] - o[1]) * (q[0] - o[0])
    sign = lambda v: (v > 0) - (v < 0)
    grid = [(whole(a), whole(b)) for a, b in edges]
    for i, (a, b) in enumerate(grid):
        for c, d in grid[:i]:
            assert not (sign(side(a, b, c)) * sign(side(a, b, d)) < 0 and sign(side(c, d, a)) * sign(side(c, d, b)) < 0), (a, b, c, d)
    for rings in polygons:
        assert area2(rings[0]) > 0 and all(area2(h) < 0 for h in rings[1:])
    return sum(area2(r) for rings in polygons for r in rings) / 2


def star(rng, x, y, n, most):
    return [(round(x + r * math.cos(t), 6), round(y + r * math.sin(t), 6)) for t in sorted(rng.uniform(0, 2 * math.pi) for _ in range(n)) for r in [rng.uniform(0.3, 1) * most]]


@pytest.mark.parametrize("seed, side", [(1, None), (2, None), (3, 97), (4, 100_000_000)])
def test_stars_by_points(spark, seed, side):
    rng = random.Random(seed)
    shape = (lambda: 0.004) if side == 97 else (lambda: rng.uniform(0.05, 2))
    given = [(k, [star(rng, rng.uniform(0, 2) * shape(), rng.uniform(0, 2) * shape(), rng.randint(3, 9), shape())]) for k in ("a", "b") for _ in range(12 if side != 97 else 4)]
    given += [(k, [r[0][::-1] + r[0][-1:]]) for k, r in given[:3]]  # repeated, run the other way, closed
    got = union(spark, given, side=side)
    assert set(got) == {"a", "b"}
    for k, polygons in got.items():
        check_shape(polygons)
        reach = max(abs(c) for o, rings in given if o == k for p in rings[0] for c in p)
        for _ in range(400):
            x, y = rng.uniform(-reach, reach), rng.uniform(-reach, reach)
            want = any(inside(rings[0], x, y) for o, rings in given if o == k)
            assert want == (sum(inside(r, x, y) for rings in polygons for r in rings) % 2 == 1), (k, x, y)


def test_boxes_by_cells(spark):
    rng = random.Random(5)
    boxes, cells = [], {}
    for _ in range(150):
        k, x, y, w, h = rng.choice("abc"), rng.randint(-20, 10), rng.randint(-20, 10), rng.randint(1, 6), rng.randint(1, 6)
        boxes.append((k, [[(x, y), (x + w, y), (x + w, y + h), (x, y + h)]]))
        cells.setdefault(k, set()).update((x + i, y + j) for i in range(w) for j in range(h))
    got = union(spark, boxes)
    assert {k: round(check_shape(p), 6) for k, p in got.items()} == {k: len(c) for k, c in cells.items()}


def test_holes_islands_and_touching(spark):
    box = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]
    got = union(spark, [
        ("ring", [box(0, 0, 9), box(1, 1, 7)]), ("ring", [box(3, 3, 2)]),  # an island in a hole
        ("filled", [box(0, 0, 9), box(1, 1, 7)]), ("filled", [box(1, 1, 7)]),
        ("corner", [box(0, 0, 1)]), ("corner", [box(1, 1, 1)]),
        ("crescents", [box(0, 0, 4), [(0, 0), (4, 4), (3, 1)]]),  # a hole that touches its shell in two points
        ("nothing", [[(0, 0), (1, 1), (2, 2)]]), ("nothing", [[(0, 0), (1, 1)]]),
        (None, [box(0, 0, 1)]), ("nulls", None),
    ])
    assert set(got) == {"ring", "filled", "corner", "crescents"}
    assert [len(p) for p in got["ring"]] == [2, 1] and check_shape(got["ring"]) == 81 - 49 + 4
    assert got["filled"] == [[[(0, 0), (9, 0), (9, 9), (0, 9)]]]
    assert got["corner"] == [[[(0, 0), (1, 0), (1, 1), (0, 1)]], [[(1, 1), (2, 1), (2, 2), (1, 2)]]]
    assert len(got["crescents"]) == 2 and all(len(p) == 1 for p in got["crescents"]) and check_shape(got["crescents"]) == 16 - 4


def test_empty_and_geojson(spark):
    none = spark.createDataFrame([], f"k long, rings {KIND}")
    assert m.union(none, "k", "rings").collect() == []
    one = spark.createDataFrame([(7, [[(0.0, 0.0), (1.5, 0.0), (0.0, 2.0)]])], f"k long, rings {KIND}")
    text = m.union(one, "k", "rings").select(m.multipolygon(F.col("polygons"))).first()[0]
    assert text == '{"type":"MultiPolygon","coordinates":[[[[0.0,0.0],[1.5,0.0],[0.0,2.0],[0.0,0.0]]]]}'


def test_many_areas_over_each_other(spark, monkeypatch):
    """What meets in tiles is the outlines of groups, not all areas, and small keys are done before."""
    rng, met, noded = random.Random(6), [], m.noded
    monkeypatch.setattr(m, "noded", lambda layer, side: met.append(layer.count()) or noded(layer, side))
    given = [("a", [star(rng, rng.uniform(0, 2), rng.uniform(0, 2), 7, 1)]) for _ in range(400)]
    given += [(k, [[(x, 0), (x + 2, 0), (x + 2, 3), (x, 3)]]) for k in "bcdef" for x in range(3)]
    given += [("g", [[(0, 0), (1, 0), (1, 1)], [], [(0, 0), (1, 1)], [(0.2, 0.1), (0.8, 0.1), (0.8, 0.5)]])]
    got = union(spark, given)
    assert sum(met) < 700
    for k in "bcdef":
        assert check_shape(got[k]) == 12 and len(got[k][0]) == 1
    assert len(got["g"][0]) == 2 and round(check_shape(got["g"]), 6) == 0.5 - 0.12
    check_shape(got["a"])
    for _ in range(300):
        x, y = rng.uniform(-1.2, 3.2), rng.uniform(-1.2, 3.2)
        assert any(inside(r[0], x, y) for k, r in given if k == "a") == (sum(inside(r, x, y) for rings in got["a"] for r in rings) % 2 == 1)
