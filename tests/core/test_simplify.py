import math
import random

import numpy as np
import pytest

from sparkwharf.operators import simplify as m
from tests.core.test_planar import area2, check_shape

KIND = "array<array<array<struct<lng: double, lat: double>>>>"


def simplified(spark, shapes, tolerance, together=False):
    df = spark.createDataFrame([(k, None if s is None else [[[{"lng": float(x), "lat": float(y)} for x, y in ring] for ring in rings] for rings in s]) for k, s in shapes], f"k string, shapes {KIND}")
    got = m.simplify(df.repartition(3), "k", "shapes", tolerance, together).collect()
    return {r["k"]: None if r["shapes"] is None else [[[(p["lng"], p["lat"]) for p in ring] for ring in rings] for rings in r["shapes"]] for r in got}


def wavy(a, b, n, high, rng, low=None):
    """Points from a up to but without b, beside the straight way (left of it with ``low`` 0)."""
    out = [a]
    for i in range(1, n):
        t, off = i / n, rng.uniform(-high if low is None else low, high)
        out.append((round(a[0] + t * (b[0] - a[0]) - off * (b[1] - a[1]), 6), round(a[1] + t * (b[1] - a[1]) + off * (b[0] - a[0]), 6)))
    return out


def edges(shapes):
    return {frozenset(e) for rings in shapes for ring in rings for e in zip(ring, ring[1:] + ring[:1], strict=True)}


def test_neighbours_stay_edge_to_edge(spark):
    rng, n, lines = random.Random(3), 3, {}
    def line(a, b):  # noqa: E306
        if (b, a) in lines:
            return [a, *lines[b, a][:0:-1]]
        return lines.setdefault((a, b), wavy(a, b, 20, 0.02, rng))
    shapes = [(f"{i}{j}", [[[p for a, b in zip(c, c[1:] + c[:1], strict=True) for p in line(a, b)]]]) for i in range(n) for j in range(n) for c in [[(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)]]]
    got = simplified(spark, shapes, 0.1, together=True)
    assert sum(len(s[0][0]) for s in got.values()) < sum(len(s[0][0]) for _, s in shapes) / 4
    before, after = {}, {}
    for of, each in ((before, dict(shapes)), (after, got)):
        for s in each.values():
            for e in edges(s):
                of[e] = of.get(e, 0) + 1
    # each inner border is one line that both neighbours have, the outer ones belong to one
    assert sum(v == 2 for v in after.values()) >= 2 * n * (n - 1) and max(after.values()) == 2
    assert math.isclose(sum(area2(s[0][0]) / 2 for s in got.values()), n * n, rel_tol=0.05)
    for s in got.values():
        check_shape(s)


def test_known_counts_and_single_rings(spark):
    rng = random.Random(4)
    corners = [(0, 0), (6, 0), (6, 4), (0, 4)]
    ring = [p for a, b in zip(corners, corners[1:] + corners[:1], strict=True) for p in wavy(a, b, 30, 0.0005, rng, 0)]
    hole = [(2, 1), (1, 2), (2, 3), (2.5, 2.999), (3, 3), (4, 2), (3, 1)]
    got = simplified(spark, [("a", [[ring, hole]]), ("empty", []), ("null", None)], 0.01)
    assert len(got["a"][0][0]) == 4 and set(got["a"][0][0]) == set(corners) and len(got["a"][0][1]) == 6
    assert got["empty"] == [] and got["null"] is None


def test_rings_never_cross_or_vanish(spark):
    """A comb whose teeth are finer than the tolerance, a sliver beside it, a tiny triangle, and a hole close to its shell."""
    comb = [(0, 0), (10, 0), (10, 1)] + [p for i in range(9, 0, -1) for p in ((i + 0.4, 1), (i + 0.3, 0.1), (i + 0.2, 1))] + [(0, 1)]
    shell = [(20, 0), (30, 0), (30, 5)] + [(25 + 4 * math.cos(t / 10 * math.pi), 5 + 4 * math.sin(t / 10 * math.pi)) for t in range(1, 10)] + [(20, 5)]
    hole = [(25 + 3.9 * math.cos(t / 10 * math.pi), 4.95 + 3.9 * math.sin(t / 10 * math.pi)) for t in range(1, 10)][::-1]
    rnd = lambda r: [(round(x, 6), round(y, 6)) for x, y in r]
    shapes = [("k", [[rnd(comb)], [rnd(shell), rnd(hole) if area2(rnd(hole)) < 0 else rnd(hole)[::-1]], [[(40, 0), (40.01, 0), (40, 0.01)]]])]
    for tolerance in (0.05, 1.0, 50.0):
        got = simplified(spark, shapes, tolerance)["k"]
        assert [len(p) for p in got] == [1, 2, 1] and all(len(r) >= 3 for p in got for r in p)
        check_shape(got)


def test_levels_are_those_of_the_recursive_rule():
    def kept(points, tolerance):
        if len(points) < 3:
            return points
        (ax, ay), (bx, by) = points[0], points[-1]
        def off(p):  # noqa: E306
            dx, dy = bx - ax, by - ay
            t = max(0, min(1, ((p[0] - ax) * dx + (p[1] - ay) * dy) / (dx * dx + dy * dy))) if dx or dy else 0
            return math.hypot(p[0] - ax - t * dx, p[1] - ay - t * dy)
        k = max(range(1, len(points) - 1), key=lambda i: off(points[i]))
        return [points[0], points[-1]] if off(points[k]) <= tolerance else kept(points[: k + 1], tolerance)[:-1] + kept(points[k:], tolerance)
    rng = np.random.default_rng(5)
    for _ in range(30):
        xy = np.cumsum(rng.integers(-50, 60, (40, 2)), axis=0)
        level = m.levels(xy[:, 0], xy[:, 1])
        for tolerance in (0, 5, 30, 200):
            assert [tuple(p) for p in xy[level > tolerance].tolist()] == kept([tuple(p) for p in xy.tolist()], tolerance)


@pytest.mark.parametrize("nodes", [[], [0], [1, 3], [0, 1, 2, 3, 4]])
def test_arcs_are_the_ring_again(nodes):
    points = [(5, 5), (9, 1), (9, 9), (2, 7), (1, 3)]
    arcs = m.arcs_of(points, [i in nodes for i in range(5)])
    ways = [(arc[::-1] if flip else arc)[:-1] for flip, arc in arcs]
    ring = [p for w in ways for p in w]
    at = ring.index(points[0])
    assert ring[at:] + ring[:at] == points and len(arcs) == (len(nodes) or 2)


def test_alert_day_is_the_union_simplified(spark):
    """Each alert's GeoJSON holds the points of its united areas but those within the tolerance of the outline."""
    import json

    from sparkwharf.operators import planar
    from sparkwharf.plans import shapes
    from tests.core.test_planar import inside

    sf = "/root/testdata/sf0.01"
    alerts, areas = shapes.alert_areas(spark, sf, "1997-01-15")
    whole = {r["identifier"]: r["polygons"] for r in planar.union(areas, "identifier", "rings").collect()}
    got = {r["identifier"]: r["geom"] for r in shapes.alert_day(spark, sf).collect()}
    assert set(got) == {r["identifier"] for r in alerts.collect()} and {k for k, g in got.items() if g} == set(whole)
    rng = random.Random(1)
    for k, polygons in whole.items():
        made = [[[tuple(p) for p in ring[:-1]] for ring in rings] for rings in json.loads(got[k])["coordinates"]]
        check_shape(made)
        true = [[(p["lng"], p["lat"]) for p in ring] for rings in polygons for ring in rings]
        lines = [(a, b) for r in true for a, b in zip(r, r[1:] + r[:1], strict=True)]
        for _ in range(100):
            x, y = rng.uniform(0, 3), rng.uniform(0, 3)
            off = min(math.hypot(x - a[0] - t * (b[0] - a[0]), y - a[1] - t * (b[1] - a[1])) for a, b in lines for t in [max(0, min(1, ((x - a[0]) * (b[0] - a[0]) + (y - a[1]) * (b[1] - a[1])) / ((b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2)))])
            if off > 0.002:
                assert (sum(inside(r, x, y) for r in true) % 2) == (sum(inside(r, x, y) for rings in made for r in rings) % 2)
