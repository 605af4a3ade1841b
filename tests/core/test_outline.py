"""Outlines of cell unions against the cells themselves."""

import json
import random

from sparkwharf.operators import outline
from sparkwharf.plans import upkeep

SF = "/root/testdata/sf0.001"


def covered(geom: str, step: float) -> set[tuple[int, int]]:
    """Cells whose middle lies inside: brute force over the bounds."""
    out = set()
    for rings in json.loads(geom)["coordinates"]:
        lines = [(a, b) for r in rings for a, b in zip(r, r[1:])]
        xs, ys = [p[0] for p in rings[0]], [p[1] for p in rings[0]]
        for i in range(round(min(xs) / step), round(max(xs) / step)):
            for j in range(round(min(ys) / step), round(max(ys) / step)):
                x, y = (i + 0.5) * step, (j + 0.5) * step
                if sum((a[1] > y) != (b[1] > y) and a[0] > x for a, b in lines) % 2:
                    assert (i, j) not in out
                    out.add((i, j))
    return out


def rings_are_simple(geom: str) -> bool:
    rings = [r for p in json.loads(geom)["coordinates"] for r in p]
    return all(r[0] == r[-1] and len({tuple(q) for q in r[:-1]}) == len(r) - 1 for r in rings)


def test_random_cells(spark):
    random.seed(5)
    want = {k: {(random.randint(-3, 6), random.randint(-3, 6)) for _ in range(n)} for k, n in enumerate((1, 5, 20, 40, 70, 95, 120, 300))}
    rows = [(k, x, y) for k, cells in want.items() for x, y in cells]
    rows += rows[:30] + [(None, 1, 1), (3, None, 0), (3, 0, None)]
    got = {r["k"]: r["geom"] for r in outline.cell_union(spark.createDataFrame(rows, "k long, x int, y int"), "k", 0.5).collect() if r["k"] is not None}
    assert {k: covered(g, 0.5) for k, g in got.items()} == want
    assert all(rings_are_simple(g) for g in got.values())


def test_hole_and_corner(spark):
    ring = [(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    rows = [("o", x, y) for x, y in ring] + [("d", 0, 0), ("d", 1, 1), ("s", 0, 0), ("s", 1, 0)]
    got = {r["k"]: json.loads(r["geom"])["coordinates"] for r in outline.cell_union(spark.createDataFrame(rows, "k string, x int, y int"), "k").collect()}
    assert [len(p) for p in got["o"]] == [2]
    assert [len(p) for p in got["d"]] == [1, 1]
    assert got["s"] == [[[[0.0, 0.0], [2.0, 0.0], [2.0, 1.0], [0.0, 1.0], [0.0, 0.0]]]]
    assert outline.cell_union(spark.createDataFrame([], "k string, x int, y int"), "k").count() == 0
