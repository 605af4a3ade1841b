"""Daily pre-aggregates: ordered trails, timelines, frames, their summaries, and bucketed cells.

Points are collected as arrays of structs and sorted by the order key inside the
row, so that no global sort is needed and partial aggregation applies; text is rendered last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwharf.functions.timeutil import OFFSET_HOURS, in_local_day, local_time, floor_minutes, time_key


def packed(order: list[Column], text: Column, sep: str = ";") -> Column:
    """Aggregate: the texts joined in the order of the keys; a null text counts as empty."""
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], F.coalesce(text, F.lit("")).alias("text"))
    return F.array_join(F.transform(F.array_sort(F.collect_list(key)), lambda p: p["text"]), sep)


def daily_trails(points: DataFrame, day: str, entity: list[str], ts: str, text: Column, order: list[Column], carried: dict[str, Column] | None = None, where: Column | None = None, widen_hours: float = 1, least_points: int = 2) -> DataFrame:
    """One row per entity of a civil day widened by an hour: the packed trail, carried aggregates and the point count."""
    rows = points.filter(in_local_day(F.col(ts), day, OFFSET_HOURS, widen_hours))
    if where is not None:
        rows = rows.filter(where)
    carried = carried or {}
    out = rows.groupBy(*entity).agg(packed(order, text).alias("trail"), *[c.alias(n) for n, c in carried.items()], F.count(F.lit(1)).cast("int").alias("point_count"))
    return out.filter(F.col("point_count") >= least_points).select(F.lit(day).alias("day"), *entity, "trail", *carried, "point_count")


def day_summary(trails: DataFrame, day: str) -> DataFrame:
    """Records and entities of a day; zero for an empty one."""
    return trails.agg(F.coalesce(F.sum("point_count"), F.lit(0)).alias("records"), F.count(F.lit(1)).alias("entities")).select(F.lit(day).alias("day"), "records", "entities")


def bucket_cells(rows: DataFrame, cells: DataFrame, key: str, ts: str, part: str, whole: str, minutes: int = 15, offset_hours: float = OFFSET_HOURS) -> DataFrame:
    """Fill ratio and mean size per (resolution, cell, civil bucket); buckets without any size are left out."""
    keyed = rows.join(cells, key).withColumn("time_key", time_key(floor_minutes(local_time(F.col(ts), offset_hours), minutes)))
    agg = keyed.groupBy("resolution", "cell", "time_key").agg((F.sum(part) / F.nullif(F.sum(whole), F.lit(0))).alias("fullness"), F.avg(whole).alias("avg_total"))
    return agg.filter(F.col("fullness").isNotNull())


def cell_frames(cells: DataFrame) -> DataFrame:
    """One row per (resolution, bucket) with all its cells as a JSON array in cell order."""
    one = F.struct(F.col("cell").alias("h"), F.round(F.col("fullness").cast("decimal(20,10)"), 4).alias("fr"), F.round(F.col("avg_total").cast("decimal(20,10)"), 1).alias("sc"))
    return cells.groupBy("resolution", "time_key").agg(F.to_json(F.array_sort(F.collect_list(one))).alias("cells"), F.count(F.lit(1)).alias("n_cells"))
