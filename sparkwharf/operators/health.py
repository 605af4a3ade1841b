"""Freshness, verdicts and incident rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwharf.functions.timeutil import epoch_micros

# Severity order.
RANK = {"ok": 0, "expected": 0, "watch": 1, "critical": 2}


def age_minutes(newest: Column, as_of: Column) -> Column:
    """Whole minutes, cut toward zero."""
    m = (epoch_micros(as_of) - epoch_micros(newest)) / F.lit(60e6)
    return F.when(m < 0, F.ceil(m)).otherwise(F.floor(m)).cast("long")


def freshness(newest: Column, interval_min: Column, as_of: Column) -> Column:
    age = age_minutes(newest, as_of)
    return F.when(newest.isNull(), "NEVER").when(age < interval_min * 3, "OK").when(age < interval_min * 12, "STALE").otherwise("DEAD")


def table_health(rows: DataFrame, specs: DataFrame, name: str, ts: str, as_of: Column) -> DataFrame:
    """Per registered table: newest row, rows of the last day, class and age; tables without rows appear as NEVER."""
    day = F.col(ts) >= as_of - F.expr("INTERVAL 24 HOURS")
    agg = rows.groupBy(name).agg(F.max(ts).alias("newest"), F.count_if(day).alias("rows_24h"))
    j = specs.join(agg, name, "left")
    return j.select(name, "interval_min", F.coalesce("rows_24h", F.lit(0)).alias("rows_24h"), age_minutes(F.col("newest"), as_of).alias("age_min"), freshness(F.col("newest"), F.col("interval_min"), as_of).alias("status"))


def verdict(health: DataFrame) -> DataFrame:
    return health.agg(
        F.when(F.bool_or(F.col("critical") & F.col("status").isin("DEAD", "NEVER")), "severe").when(F.bool_or(F.col("status") != "OK"), "problem").otherwise("normal").alias("verdict")
    )


def writes_ok(interval_min: Column, newest: Column, rows_24h: Column, as_of: Column) -> Column:
    """Rare feeds by the age of their newest row, others by any row in a day."""
    rare = age_minutes(newest, as_of) < F.greatest(interval_min * 3, F.lit(1440))
    return F.when(interval_min >= 720, F.coalesce(rare, F.lit(False))).otherwise(F.coalesce(rows_24h > 0, F.lit(False)))


def diagnosis(heartbeat: Column, rows: Column, archive: Column) -> Column:
    """What is broken, by which of the three layers move."""
    a, b, c = heartbeat, rows, archive
    return (
        F.when(~a & ~b & ~c, "all layers stopped").when(~a & ~b, "collector and table stopped").when(a & b & ~c, "archive missing")
        .when(a & ~b & c, "table not written").when(~a & b, "heartbeat lost").when(a & b & c, "ok").otherwise("layer missing")
    )


def archive_expected(as_of_day: Column, lag_days: Column) -> Column:
    return F.date_sub(as_of_day, lag_days)


def anomaly_level(state: Column, critical: Column, notes: Column, expected: list[str]) -> Column:
    noted = F.lit(False)
    for m in expected:
        noted = noted | F.contains(F.lower(F.coalesce(notes, F.lit(""))), F.lit(m))
    return F.when(~critical & noted, "expected").when(critical & state.isin("ERROR", "DEAD"), "critical").otherwise("watch")


def archive_level(state: Column, critical: Column, hour: Column, deadline: int = 4) -> Column:
    return F.when(state == "OK", "ok").when(hour < deadline, "watch").when(critical, "critical").otherwise("watch")


def quiet_hours(ts: Column, start: int, end: int) -> Column:
    """Hours from start to end, around midnight if start is later."""
    h = F.hour(ts)
    return ((h >= start) | (h < end)) if start > end else ((h >= start) & (h < end))


def market_hours(ts: Column, opens: str = "09:00:00", closes: str = "13:30:00") -> Column:
    """Working days from the opening to the closing time, both included to the microsecond; a missing time is closed."""
    clock = F.date_format(ts, "HH:mm:ss.SSSSSS")
    return F.coalesce((F.weekday(ts) < 5) & clock.between(f"{opens}.000000", f"{closes}.000000"), F.lit(False))


def severity_counts(audit: DataFrame, as_of: Column) -> DataFrame:
    """Rows, last run, oldest age and size by severity."""
    return audit.groupBy("severity").agg(
        F.count(F.lit(1)).alias("n"), F.max("run").alias("last_run"), age_minutes(F.min("at"), as_of).alias("oldest_min"), F.round(F.sum("bytes") / F.lit(1024.0), 2).alias("kb")
    )
