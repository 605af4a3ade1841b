"""Joins with a shape of their own: range, as-of, gazetteer, spatial candidates, track matching, reconciliation."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_range(points: DataFrame, ranges: DataFrame, same: list[str], at: str, low: str, high: str, first: list[str], width: float) -> DataFrame:
    """``points`` with how many ranges hold each, ends included, and the smallest of those by ``first``, which begins with ``low``: ``hits, best``.

    No pair is formed: ranges are listed under the cells of ``width`` that they cover, points under their own, and in
    a cell, in order, the ranges begun less those ended are the ones that hold a point. Of all that end at the point or behind it the first one begins
    before the point if any does, so a running minimum finds it. Nulls in ``same`` are equal; choose ``width`` near the usual range.
    """
    cells = F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))
    r = ranges.filter(F.col(low) <= F.col(high)).withColumn("_cell", F.explode(cells))
    p = points.withColumn("_cell", F.floor(F.col(at) / width)).filter("_cell IS NOT NULL")
    best, point = (F.struct(*c) for c in (first, points.columns))
    kinds = {c: d.schema[0].dataType for c, d in (("best", r.select(best)), ("point", points.select(point)))}
    none = {c: F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()}
    row = lambda d, pos, kind, n, b, q: d.select(*same, "_cell", F.col(pos).alias("_pos"), F.lit(kind).alias("_kind"), F.lit(n).cast("long").alias("_n"), b, q)
    every = row(r, low, 0, 1, none["best"], none["point"]).union(row(p, at, 1, 0, none["best"], point.alias("point"))).union(row(r, high, 2, -1, best.alias("best"), none["point"]))
    cell, upto = Window.partitionBy(*same, "_cell"), (Window.unboundedPreceding, Window.currentRow)
    hits = F.sum("_n").over(cell.orderBy("_pos", "_kind").rowsBetween(*upto))
    ahead = F.min("best").over(cell.orderBy(F.desc("_pos"), F.desc("_kind")).rowsBetween(*upto))
    return every.withColumns({"hits": hits, "ahead": ahead}).filter("_kind = 1 AND hits > 0").select("point.*", "hits", F.col("ahead").alias("best"))


def match_sections(points: DataFrame, sections: DataFrame, width: float) -> DataFrame:
    """``points(id, road, dir, km)`` with status and the first matching section of ``sections(road, dir, low, high, section)``.

    A direction that is missing, ``B`` or unknown to the road falls back to all of the road's
    directions. Status: matched, multi_match, km_out (road known) or no_section.
    """
    known = sections.select("road", "dir").distinct().withColumn("_has_dir", F.lit(True))
    roads = sections.select("road").distinct().withColumn("_has_road", F.lit(True))
    p = points.join(roads, "road", "left").join(known, ["road", "dir"], "left")
    p = p.withColumn("_want", F.when(F.col("_has_dir") & (F.col("dir") != "B"), F.col("dir")))
    # a section is there under its own direction and under none, which stands for all of the road's
    s = sections.filter("dir IS NOT NULL").withColumnRenamed("dir", "_want").unionByName(sections.drop("dir").withColumn("_want", F.lit(None).cast("string")))
    met = first_range(p.filter("_has_road").select("id", "road", "_want", "km"), s, ["road", "_want"], "km", "low", "high", ["low", "section"], width)
    hits = met.groupBy("id").agg(F.sum("hits").alias("hits"), F.min("best")["section"].alias("section"))
    out = p.join(hits, "id", "left")
    status = F.when(F.col("_has_road").isNull(), "no_section").when(F.col("hits").isNull(), "km_out").when(F.col("hits") == 1, "matched").otherwise("multi_match")
    return out.select("id", status.alias("status"), "section")


def as_of(points: DataFrame, history: DataFrame, key: list[str], at: str, since: str, most_age: Column) -> DataFrame:
    """The latest row of history at or before each point, no older than ``most_age``.

    Both sides share one sorted stream per key, so no pair is formed: the last
    history row is carried forward over the points.
    """
    cols = [c for c in history.columns if c not in key]
    h = history.select(*key, F.col(since).alias("_t"), F.lit(0).alias("_kind"), F.struct(*cols).alias("_h"), F.lit(None).cast(points.select(F.struct(*points.columns).alias("s")).schema["s"].dataType).alias("_p"))
    p = points.select(*key, F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast(history.select(F.struct(*cols).alias("s")).schema["s"].dataType).alias("_h"), F.struct(*points.columns).alias("_p"))
    w = Window.partitionBy(*key).orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = h.unionByName(p).withColumn("_last", F.last("_h", ignorenulls=True).over(w)).filter("_kind = 1")
    fresh = F.col("_last." + since) >= F.col("_t") - most_age
    return carried.select("_p.*", *[F.when(fresh, F.col("_last." + c)).alias(c) for c in cols])


def degrade(rows: DataFrame, gazetteer: DataFrame, code: str, prefix: int = 3) -> DataFrame:
    """A place code kept if known, cut to its prefix if only that is known, else null."""
    full = gazetteer.select(F.col("code").alias(code)).distinct().withColumn("_full", F.lit(True))
    wide = gazetteer.select(F.substring("code", 1, prefix).alias("_prefix")).distinct().withColumn("_wide", F.lit(True))
    j = rows.withColumn("_prefix", F.substring(code, 1, prefix)).join(full, code, "left").join(wide, "_prefix", "left")
    out = F.when(F.col("_full"), F.col(code)).when(F.col("_wide"), F.col("_prefix"))
    return j.withColumn("resolved", out).drop("_prefix", "_full", "_wide")


def resolve_by_priority(rows: DataFrame, key: str, own: str, *others: DataFrame) -> DataFrame:
    """``value``: the row's own, else the first of the other sources' (key, value) that has one."""
    for i, other in enumerate(others):
        rows = rows.join(other.select(F.col(other.columns[0]).alias(key), F.col(other.columns[1]).alias(f"_v{i}")), key, "left")
    names = [f"_v{i}" for i in range(len(others))]
    return rows.withColumn("value", F.coalesce(own, *names)).drop(*names)


def in_boxes(points: DataFrame, boxes: DataFrame, width: float) -> DataFrame:
    """Points with every box (west, south, east, north) that holds them: boxes are listed under the grid cells they cover."""
    b = boxes.withColumn("_x", F.explode(F.sequence(F.floor(F.col("west") / width), F.floor(F.col("east") / width))))
    b = b.withColumn("_y", F.explode(F.sequence(F.floor(F.col("south") / width), F.floor(F.col("north") / width))))
    p = points.withColumns({"_x": F.floor(F.col("lng") / width), "_y": F.floor(F.col("lat") / width)})
    return p.join(b, ["_x", "_y"]).filter(F.col("lng").between(F.col("west"), F.col("east")) & F.col("lat").between(F.col("south"), F.col("north"))).drop("_x", "_y")


def match_tracks(trips: DataFrame, tracks: DataFrame) -> DataFrame:
    """The best track of each trip.

    ``trips(trip, origin, dest, stops array)``, ``tracks(track, station, progress, origin, dest)``.
    Tracks of exactly the same ends go first, else those that hold both ends in order; the best has
    the least share of backward steps, then most stops covered, then the better kind, then the smaller name.
    Each distinct stop list is scored once: against the tracks of its ends, and against all that share a station only where none of those fits.
    A track's rows are made by its stations, so they are more than its table's size tells, and no side is broadcast by that.
    """
    stops = ["origin", "dest", "stops"]
    tr = tracks.select("track", "station", "progress", F.col("origin").alias("_o"), F.col("dest").alias("_d"))
    lists = trips.select(*stops).distinct()
    legs = lists.select(*stops, F.size("stops").alias("n"), F.posexplode("stops").alias("i", "station"))
    same = _best_tracks(legs.join(tr.hint("merge"), (F.col("origin") == F.col("_o")) & (F.col("dest") == F.col("_d")) & (legs["station"] == tr["station"])).drop(tr["station"]), stops)
    null_safe = lambda l, r: reduce(and_, [l[c].eqNullSafe(r[c]) for c in stops])
    left = legs.join(same, null_safe(legs, same), "left_anti")
    best = same.unionByName(_best_tracks(left.join(tr.hint("merge"), "station"), stops))
    return trips.join(best.hint("merge"), null_safe(trips, best)).select("trip", "track")


def _best_tracks(on: DataFrame, stops: list[str]) -> DataFrame:
    """The best track of each stop list among the stops met by a track."""
    w = Window.partitionBy(*stops, "track").orderBy("i")
    step = F.col("progress") - F.lag("progress").over(w)
    per = on.withColumn("step", step).groupBy(*stops, "track").agg(
        F.count_if(F.col("step") > 0).alias("ahead"),
        F.count_if(F.col("step") < 0).alias("back"),
        (F.count_distinct("station") / F.first("n")).alias("cover"),
        F.bool_or((F.col("_o") == F.col("origin")) & (F.col("_d") == F.col("dest"))).alias("exact"),
        F.max(F.when(F.col("station") == F.col("origin"), F.col("progress"))).alias("p0"),
        F.max(F.when(F.col("station") == F.col("dest"), F.col("progress"))).alias("p1"),
    )
    fits = per.filter(F.col("exact") | (F.col("p0") < F.col("p1")))
    kind = F.when(F.col("track").startswith("OD-"), 0).when(F.col("track").startswith("SP-"), 1).when(F.col("track").startswith("BB-"), 2).otherwise(3)
    share = F.coalesce(F.try_divide("back", F.col("ahead") + F.col("back")), F.lit(0.0))
    return fits.groupBy(*stops).agg(F.min_by("track", F.struct(~F.col("exact"), share, -F.col("cover"), kind, F.col("track"))).alias("track"))


def reconcile(a: DataFrame, b: DataFrame, key: list[str], value: str) -> DataFrame:
    """Both directions of a comparison: only_a, only_b, differs or ok by key."""
    j = a.select(*key, F.col(value).alias("a")).join(b.select(*key, F.col(value).alias("b")), key, "full")
    state = F.when(F.col("b").isNull(), "only_a").when(F.col("a").isNull(), "only_b").when(F.col("a") != F.col("b"), "differs").otherwise("ok")
    return j.select(*key, "a", "b", state.alias("state"))
