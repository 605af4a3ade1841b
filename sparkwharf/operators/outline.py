"""Unions of grid cells as GeoJSON outlines.

Cells are made distinct and their shared edges cancel in shuffles that combine; only what is left, the outline of one
geometry, meets in a task, where it becomes one value anyway.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Point = tuple[int, int]


def _loops(edges: list[tuple[Point, Point]]) -> Iterator[list[Point]]:
    """Simple rings of directed edges; a walk that meets its own way again gives off a ring there."""
    after: dict[Point, list[Point]] = {}
    for a, b in sorted(edges, reverse=True):
        after.setdefault(a, []).append(b)
    for start in sorted(after):
        while after[start]:
            way, place = [start], {start: 0}
            while after[way[-1]]:
                at = after[way[-1]].pop()
                if at in place:
                    yield way[place[at] :]
                    for p in way[place[at] + 1 :]:
                        del place[p]
                    way = way[: place[at] + 1]
                else:
                    place[at] = len(way)
                    way.append(at)


def _area(ring: list[Point]) -> float:
    return sum(x * v - u * y for (x, y), (u, v) in zip(ring, ring[1:] + ring[:1])) / 2


def _corners(ring: list[Point]) -> list[Point]:
    """Without points on a straight line, from the smallest corner on."""
    turns = [q for p, q, r in zip(ring[-1:] + ring[:-1], ring, ring[1:] + ring[:1]) if (q[0] - p[0]) * (r[1] - q[1]) != (q[1] - p[1]) * (r[0] - q[0])]
    first = turns.index(min(turns))
    return turns[first:] + turns[:first]


def _holds(ring: list[Point], x: float, y: float) -> bool:
    crossings = [(a, b) for a, b in zip(ring, ring[1:] + ring[:1]) if (a[1] > y) != (b[1] > y)]
    return sum(x < a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in crossings) % 2 == 1


def multipolygon(edges: list[tuple[Point, Point]], step: float) -> str:
    """GeoJSON of the area to the left of the edges: shells run against the clock, each with its holes."""
    shells, holes = [], []
    for ring in _loops(edges):
        (shells if _area(ring) > 0 else holes).append(_corners(ring))
    shells.sort(key=lambda r: (_area(r), r))
    inside: list[list[list[Point]]] = [[] for _ in shells]
    for hole in sorted(holes):
        (x, y), (u, v) = hole[0], hole[1]
        dx, dy = (u > x) - (u < x), (v > y) - (v < y)
        px, py = x + (dx - dy) / 2, y + (dy + dx) / 2  # the middle of the cell left of the first edge
        inside[next(i for i, shell in enumerate(shells) if _holds(shell, px, py))].append(hole)
    polygons = sorted([shell, *own] for shell, own in zip(shells, inside, strict=True))
    closed = [[[[x * step, y * step] for x, y in ring + ring[:1]] for ring in rings] for rings in polygons]
    return json.dumps({"type": "MultiPolygon", "coordinates": closed}, separators=(",", ":"))


def cell_union(cells: DataFrame, key: str, step: float = 1.0) -> DataFrame:
    """``key, geom`` of ``cells(key, x, y)``: the outline of each key's cells of ``step``, points on straight lines left out.

    Repeated cells count once; rows with a null in key, x or y take no part.
    """
    once = cells.select(key, F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y")).dropna().distinct()
    edge = lambda dx, dy, flat, way: F.struct((F.col("x") + dx).alias("ex"), (F.col("y") + dy).alias("ey"), F.lit(flat).alias("flat"), F.lit(way).alias("way"))
    around = F.array(edge(0, 0, True, 1), edge(1, 0, False, 1), edge(0, 1, True, -1), edge(0, 0, False, -1))
    left = once.select(key, F.explode(around).alias("e")).groupBy(key, "e.ex", "e.ey", "e.flat").agg(F.sum("e.way").alias("way")).filter("way <> 0")

    def drawn(rows: pd.DataFrame) -> pd.DataFrame:
        edges = []
        for x, y, flat, way in zip(rows["ex"].tolist(), rows["ey"].tolist(), rows["flat"].tolist(), rows["way"].tolist(), strict=True):
            a, b = (x, y), (x + 1, y) if flat else (x, y + 1)
            edges.append((a, b) if way > 0 else (b, a))
        return pd.DataFrame({key: [rows[key].iloc[0]], "geom": [multipolygon(edges, step)]})

    return left.groupBy(key).applyInPandas(drawn, f"{key} {dict(cells.dtypes)[key]}, geom string")
