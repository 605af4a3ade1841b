"""Aggregations with rules of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upper_median(rows: DataFrame, key: list[str], value: Column) -> DataFrame:
    """Per key the element n div 2 of the sorted values, from the counts of distinct values; no group is collected."""
    n = rows.withColumn("_v", value).filter("_v IS NOT NULL").groupBy(*key, "_v").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*key)
    upto, whole = F.sum("_n").over(w.orderBy("_v")), F.sum("_n").over(w)
    # the first value behind which more than n div 2 values lie
    return n.withColumns({"_upto": upto, "_whole": whole}).filter(F.col("_upto") > F.floor(F.col("_whole") / 2)).groupBy(*key).agg(F.min("_v").alias("median"))


def global_rank(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Ranks over all rows: inside ranges of the order, plus the sizes of the ranges before (a row a range)."""
    ranged = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged = ranged.checkpoint() if rows.sparkSession.sparkContext.getCheckpointDir() else ranged.persist()
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = ranged.withColumn("_i", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    return inside.join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + F.col("_i")).drop("_range", "_i", "_before")


def detector_rollup(lanes: DataFrame, key: list[str]) -> DataFrame:
    """Volumes by class and means of valid readings only: positive speeds, non-negative occupancy; zero without any."""
    valid = lambda c, ok: F.coalesce(F.avg(F.when(ok, F.col(c))), F.lit(0.0))
    return lanes.groupBy(*key).agg(
        F.sum(F.when((F.col("kind") == "S") & (F.col("volume") > 0), F.col("volume")).otherwise(0)).alias("small"),
        F.sum(F.when((F.col("kind") == "L") & (F.col("volume") > 0), F.col("volume")).otherwise(0)).alias("large"),
        valid("speed", F.col("speed") > 0).alias("speed"),
        valid("occupancy", F.col("occupancy") >= 0).alias("occupancy"),
    )


def occupancy(free: Column, total: Column) -> Column:
    """Share in use to three places; null without a size."""
    return F.when((total > 0) & (free >= 0), F.round(F.lit(1.0) - free / total, 3))


def lots_rollup(lots: DataFrame, key: list[str]) -> DataFrame:
    """Totals without unknown (negative) counts, full and tight lots, mean occupancy."""
    known = F.col("free") >= 0
    share = occupancy(F.col("free"), F.col("total"))
    return lots.groupBy(*key).agg(
        F.coalesce(F.sum(F.when(known, F.col("free"))), F.lit(0)).alias("free"),
        F.count_if(F.col("free") == 0).alias("full"),
        F.count_if(known & (F.col("free") > 0) & (F.col("free") * 10 < F.col("total"))).alias("tight"),
        F.round(F.avg(share), 4).alias("mean_occupancy"),
    )


def name_diversity(rows: DataFrame, key: str, name: str, least: int = 3, most_share: float = 0.9) -> DataFrame:
    """Keys with more than ``least`` names of which none has ``most_share`` of the rows."""
    per = rows.groupBy(key, name).agg(F.count(F.lit(1)).alias("n"))
    agg = per.groupBy(key).agg(F.count(F.lit(1)).alias("names"), F.max("n").alias("most"), F.sum("n").alias("total"), F.max_by(name, F.struct("n", name)).alias("main"))
    return agg.filter((F.col("names") > least) & (F.col("most") < most_share * F.col("total"))).select(key, "names", "main")


def raster_digest(cells: DataFrame, key: list[str], value: str) -> DataFrame:
    """Extremes, mean, counts of valid and NaN cells; nulls for a variable without any valid cell."""
    ok = F.when(~F.isnan(value), F.col(value))
    return cells.groupBy(*key).agg(F.max(ok).alias("max"), F.min(ok).alias("min"), F.round(F.avg(ok), 4).alias("mean"), F.count(ok).alias("n"), F.count_if(F.isnan(value)).alias("nan_count"))


def displacement_class(rows: DataFrame, key: str, metres: Column) -> DataFrame:
    """How far an entity moved over the period: still, near or moving."""
    span = rows.groupBy(key).agg((F.max(metres) - F.min(metres)).alias("span"))
    return span.select(key, F.when(F.col("span") < 300, "still").when(F.col("span") < 2000, "near").otherwise("moving").alias("moved"))


def fingerprint(table: DataFrame, *stamps: str) -> DataFrame:
    """Count and newest stamp as one text, to tell whether a table changed."""
    return table.agg(F.concat_ws("|", F.count(F.lit(1)).cast("string"), F.date_format(F.max(F.coalesce(*stamps)), "yyyy-MM-dd")).alias("fingerprint"))
