"""Trips from positions: de-duplicate, snap, drop impossible speeds, split at gaps, group; and what follows matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwharf.functions.geo import haversine_km, near_cells
from sparkwharf.functions.timeutil import epoch_micros


def first_per_key(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def nearest(points: DataFrame, places: DataFrame, point_key: list[str], within: float, same: list[str] | None = None) -> DataFrame:
    """``points(lng, lat)`` with ``place_id, place_lng, place_lat`` of the nearest place in the box of +-``within`` degrees, or nulls.

    Places meet points in grid cells as wide as the box, so each point sees the
    places of 9 cells by an equi-join; no join on an inequality. Points of one position are looked
    up once, and of the places of one position only the smallest id can be the nearest.
    """
    same = same or []
    p = places.select("place_id", F.col("lng").alias("place_lng"), F.col("lat").alias("place_lat"), *same)
    p = p.groupBy("place_lng", "place_lat", *same).agg(F.min("place_id").alias("place_id"))
    p = p.withColumns({"_cx": F.floor(F.col("place_lng") / within), "_cy": F.floor(F.col("place_lat") / within)})
    position = ["lng", "lat", *same]
    probe = points.select(*position).distinct().select(*position, F.explode(near_cells(F.col("lng"), F.col("lat"), within)).alias("_c"))
    probe = probe.withColumns({"_cx": F.col("_c.cx"), "_cy": F.col("_c.cy")}).drop("_c")
    # both sides may be more than their tables' sizes tell, so neither is broadcast by that
    met = probe.join(p.hint("merge"), ["_cx", "_cy", *same]).filter((F.abs(F.col("lng") - F.col("place_lng")) <= within) & (F.abs(F.col("lat") - F.col("place_lat")) <= within))
    d = F.pow(F.col("lng") - F.col("place_lng"), 2) + F.pow(F.col("lat") - F.col("place_lat"), 2)
    best = met.groupBy(*position).agg(F.min_by(F.struct("place_id", "place_lng", "place_lat"), F.struct(d, F.col("place_id"))).alias("_b"))
    return points.join(best, position, "left").select(*points.columns, "_b.place_id", "_b.place_lng", "_b.place_lat")


def with_speed(rows: DataFrame, key: list[str], ts: str) -> DataFrame:
    """``speed_kmh`` from the neighbour before, over all rows: zero for the first, null for no time passed."""
    w = Window.partitionBy(*key).orderBy(ts)
    lag = lambda c: F.lag(c).over(w)
    hours = (epoch_micros(F.col(ts)) - epoch_micros(lag(ts))) / F.lit(3.6e9)
    km = haversine_km(lag("lat"), lag("lng"), F.col("lat"), F.col("lng"))
    return rows.withColumn("speed_kmh", F.when(lag(ts).isNull(), F.lit(0.0)).otherwise(km / F.nullif(hours, F.lit(0.0))))


def drop_spikes(rows: DataFrame, key: list[str], ts: str, most_kmh: float = 60) -> DataFrame:
    """One pass over unfiltered neighbours, so a spike takes the row after it along."""
    return with_speed(rows, key, ts).filter(F.col("speed_kmh").isNull() | (F.col("speed_kmh") <= most_kmh)).drop("speed_kmh")


def with_trip_id(rows: DataFrame, key: list[str], ts: str, gap_seconds: float = 900) -> DataFrame:
    """``trip_id`` grows where the gap exceeds the limit; rows of one time share it."""
    w = Window.partitionBy(*key).orderBy(ts)
    gap = (epoch_micros(F.col(ts)) - epoch_micros(F.lag(ts).over(w))) / F.lit(1e6)
    split = rows.withColumn("_split", F.when(gap > gap_seconds, 1).otherwise(0))
    return split.withColumn("trip_id", F.sum("_split").over(w).cast("int")).drop("_split")


def group_trips(rows: DataFrame, key: list[str], ts: str, point: Column, carried: dict[str, Column] | None = None, least: int = 2) -> DataFrame:
    agg = rows.groupBy(*key, "trip_id").agg(
        F.min(ts).alias("started_at"), F.max(ts).alias("ended_at"), F.count(F.lit(1)).cast("int").alias("point_count"),
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(ts).alias("t"), point.alias("p")))), lambda x: x["p"]).alias("points"),
        *[c.alias(n) for n, c in (carried or {}).items()],
    )
    return agg.filter(F.col("point_count") >= least)


def pending(trips: DataFrame, key: list[str], *ledgers: DataFrame) -> DataFrame:
    """Trips that no ledger holds yet."""
    for ledger in ledgers:
        trips = trips.join(ledger.select(*key), key, "left_anti")
    return trips


def chunks(points: DataFrame, array: str, size: int = 100) -> DataFrame:
    """Chunks of at most ``size`` elements, neighbours sharing one; ``chunk`` counts from 0."""
    n = F.greatest(F.ceil((F.size(array) - 1) / (size - 1)), F.lit(1)).cast("int")
    out = points.withColumn("chunk", F.explode(F.sequence(F.lit(0), n - 1)))
    return out.withColumn(array, F.slice(array, F.col("chunk") * (size - 1) + 1, F.lit(size)))


def running_maximum(rows: DataFrame, key: list[str], order: str | list[str], value: str, out: str) -> DataFrame:
    """Progress that never falls back."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.max(value).over(w))


def islands(rows: DataFrame, key: list[str], order: str, inside: Column) -> DataFrame:
    """Runs of consecutive rows inside: ``key, run, first, last, n``."""
    w = Window.partitionBy(*key).orderBy(order)
    flagged = rows.withColumn("_in", inside)
    starts = F.when(F.col("_in") & ~F.coalesce(F.lag("_in").over(w), F.lit(False)), 1).otherwise(0)
    runs = flagged.withColumn("_s", starts).withColumn("run", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).filter("_in")
    return runs.groupBy(*key, "run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n"))


def cumulative_length(rows: DataFrame, key: list[str], order: str | list[str], step: Column, out: str) -> DataFrame:
    return rows.withColumn("_step", step).withColumn(out, F.sum("_step").over(Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))).drop("_step")


def last_per_bucket(rows: DataFrame, key: list[str], ts: str, seconds: int) -> DataFrame:
    """Down-sampling: the last point of an entity in each bucket."""
    bucket = F.floor(epoch_micros(F.col(ts)) / F.lit(seconds * 1_000_000))
    return first_per_key(rows.withColumn("bucket", bucket), [*key, "bucket"], [F.col(ts).desc()])


def revisions(rows: DataFrame, grain: list[str], order: list[str]) -> DataFrame:
    """How many rows share the grain, and this row's place by arrival."""
    w = Window.partitionBy(*grain)
    return rows.withColumn("copies", F.count(F.lit(1)).over(w)).withColumn("revision", F.row_number().over(w.orderBy(*order)))
