"""Queries: freshness and incident rules over events as feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwharf.operators import health as h
from sparkwharf.plans.register import query, table

_AS_OF = "TIMESTAMP '2024-01-30 12:00:00'"
_H = f"""
WITH s AS (SELECT user_id, (user_id % 30 + 1) * 10 AS interval_min, user_id % 4 = 0 AS critical FROM (SELECT DISTINCT user_id FROM events) UNION ALL SELECT -1, 60, TRUE),
a AS (SELECT user_id, max(ts) AS newest, count(*) FILTER (ts >= {_AS_OF} - INTERVAL 24 HOUR) AS c FROM events WHERE ts <= {_AS_OF} GROUP BY 1),
h AS (SELECT user_id, interval_min, critical, newest, coalesce(c, 0) AS rows_24h, CAST(trunc((epoch_us({_AS_OF}) - epoch_us(newest)) / 60e6) AS BIGINT) AS age_min FROM s LEFT JOIN a USING (user_id)),
f AS (SELECT *, CASE WHEN newest IS NULL THEN 'NEVER' WHEN age_min < interval_min * 3 THEN 'OK' WHEN age_min < interval_min * 12 THEN 'STALE' ELSE 'DEAD' END AS status FROM h)
"""


def _as_of():
    return F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")


def _specs(spark, sf):
    users = table(spark, sf, "events").select("user_id").distinct()
    specs = users.select("user_id", ((F.col("user_id") % 30 + 1) * 10).alias("interval_min"), (F.col("user_id") % 4 == 0).alias("critical"))
    return specs.union(spark.range(1).select(F.lit(-1).cast("long"), F.lit(60).cast("long"), F.lit(True)))


def _health(spark, sf):
    ev = table(spark, sf, "events").filter(F.col("ts") <= _as_of())
    specs = _specs(spark, sf)
    return h.table_health(ev, specs, "user_id", "ts", _as_of()).join(specs.select("user_id", "critical"), "user_id")


@query("g23_m1_a8_freshness", _H + "SELECT user_id, interval_min, rows_24h, age_min, status FROM f")
def freshness(spark, sf):
    return _health(spark, sf).drop("critical")


@query("m2_verdict", _H + "SELECT CASE WHEN bool_or(critical AND status IN ('DEAD', 'NEVER')) THEN 'severe' WHEN bool_or(status <> 'OK') THEN 'problem' ELSE 'normal' END AS verdict FROM f")
def verdict(spark, sf):
    return h.verdict(_health(spark, sf))


@query("m3_writes_ok", _H + "SELECT user_id, CASE WHEN interval_min * 10 >= 720 THEN coalesce(age_min < greatest(interval_min * 30, 1440), FALSE) ELSE rows_24h > 0 END AS ok FROM f")
def writes(spark, sf):
    ev = table(spark, sf, "events").filter(F.col("ts") <= _as_of())
    agg = ev.groupBy("user_id").agg(F.max("ts").alias("newest"), F.count_if(F.col("ts") >= _as_of() - F.expr("INTERVAL 24 HOURS")).alias("c"))
    return _specs(spark, sf).join(agg, "user_id", "left").select("user_id", h.writes_ok(F.col("interval_min") * 10, F.col("newest"), F.col("c"), _as_of()).alias("ok"))


@query("m4_diagnosis", """
WITH l AS (SELECT o_orderkey AS k, o_orderkey % 2 = 0 AS a, o_orderkey % 3 = 0 AS b, o_orderkey % 5 < 3 AS c FROM orders)
SELECT k, CASE WHEN NOT a AND NOT b AND NOT c THEN 'all layers stopped' WHEN NOT a AND NOT b THEN 'collector and table stopped' WHEN a AND b AND NOT c THEN 'archive missing' WHEN a AND NOT b AND c THEN 'table not written' WHEN NOT a AND b THEN 'heartbeat lost' WHEN a AND b AND c THEN 'ok' ELSE 'layer missing' END AS what FROM l""")
def diagnosis(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(k.alias("k"), h.diagnosis(k % 2 == 0, k % 3 == 0, k % 5 < 3).alias("what"))


@query("m5_archive_expected", "SELECT s_suppkey, strftime(DATE '2024-01-30' - (s_suppkey % 5)::INT, '%Y-%m-%d') AS expected FROM supplier")
def archive_expected(spark, sf):
    day = h.archive_expected(F.lit("2024-01-30").cast("date"), (F.col("s_suppkey") % 5).cast("int"))
    return table(spark, sf, "supplier").select("s_suppkey", F.date_format(day, "yyyy-MM-dd").alias("expected"))


@query("m6_m7_levels", """
WITH i AS (SELECT p_partkey AS k, CASE p_size % 4 WHEN 0 THEN 'OK' WHEN 1 THEN 'DEAD' WHEN 2 THEN 'ERROR' ELSE 'STALE' END AS state, p_partkey % 3 = 0 AS critical, CASE WHEN p_partkey % 5 = 0 THEN 'Seasonal pause' END AS notes, p_size % 24 AS hr FROM part)
SELECT k, CASE WHEN NOT critical AND contains(lower(coalesce(notes, '')), 'seasonal') THEN 'expected' WHEN critical AND state IN ('ERROR', 'DEAD') THEN 'critical' ELSE 'watch' END AS level, CASE WHEN state = 'OK' THEN 'ok' WHEN hr < 4 THEN 'watch' WHEN critical THEN 'critical' ELSE 'watch' END AS archive FROM i""")
def levels(spark, sf):
    k, s = F.col("p_partkey"), F.col("p_size")
    state = F.element_at(F.array(*map(F.lit, ("OK", "DEAD", "ERROR", "STALE"))), s % 4 + 1)
    notes = F.when(k % 5 == 0, "Seasonal pause")
    return table(spark, sf, "part").select(k.alias("k"), h.anomaly_level(state, k % 3 == 0, notes, ["seasonal"]).alias("level"), h.archive_level(state, k % 3 == 0, s % 24).alias("archive"))


@query("g24_audit", f"""
SELECT event_type AS severity, count(*) AS n, max(user_id) AS last_run, CAST(trunc((epoch_us({_AS_OF}) - epoch_us(min(ts))) / 60e6) AS BIGINT) AS oldest_min, round(sum(event_id) / 1024.0::DOUBLE, 2) AS kb FROM events GROUP BY 1""")
def audit(spark, sf):
    ev = table(spark, sf, "events").select(F.col("event_type").alias("severity"), F.col("user_id").alias("run"), F.col("ts").alias("at"), F.col("event_id").alias("bytes"))
    return h.severity_counts(ev, _as_of())
