"""Queries: trails, timelines, frames, buckets, day summaries and endpoints."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwharf.functions import timeutil as tu
from sparkwharf.operators import trails
from sparkwharf.plans.register import query, table

DAY = "2024-01-05"
# the civil day widened by an hour, in UTC
_WIDE = "ts >= TIMESTAMP '2024-01-04 15:00:00' AND ts < TIMESTAMP '2024-01-05 17:00:00'"
_DAY = "ts >= TIMESTAMP '2024-01-04 16:00:00' AND ts < TIMESTAMP '2024-01-05 16:00:00'"
_EPOCH = "((epoch_us(ts) + 500000) // 1000000)"
_CENTS = "CAST(round(value * 100) AS BIGINT)"
_POINT = f"event_type || ',' || {_CENTS} || ',' || {_EPOCH}"


def _point():
    return F.concat_ws(",", "event_type", F.round(F.col("value") * 100).cast("long").cast("string"), tu.epoch_seconds(F.col("ts")).cast("string"))


def _order():
    return [F.col("ts"), F.col("event_id")]


@query("g1_trail_day", f"""
SELECT '{DAY}' AS day, user_id, string_agg({_POINT}, ';' ORDER BY ts, event_id) AS trail, max(event_type) AS label, count(*)::INT AS point_count
FROM events WHERE {_WIDE} GROUP BY user_id HAVING count(*) >= 2""")
def trail_day(spark, sf):
    return trails.daily_trails(table(spark, sf, "events"), DAY, ["user_id"], "ts", _point(), _order(), {"label": F.max("event_type")})


@query("g2_trail_day_filtered", f"""
SELECT '{DAY}' AS day, user_id, string_agg({_POINT}, ';' ORDER BY ts, event_id) AS trail, coalesce(max(CASE WHEN event_type <> 'click' THEN event_type END), '') AS label, count(*)::INT AS point_count
FROM events WHERE {_WIDE} AND value >= 20 GROUP BY user_id HAVING count(*) >= 2""")
def trail_day_filtered(spark, sf):
    label = F.coalesce(F.max(F.when(F.col("event_type") != "click", F.col("event_type"))), F.lit(""))
    return trails.daily_trails(table(spark, sf, "events"), DAY, ["user_id"], "ts", _point(), _order(), {"label": label}, F.col("value") >= 20)


@query("g8_k12_day_summary", f"""
WITH t AS (SELECT user_id, count(*) AS n FROM events WHERE {_WIDE} GROUP BY user_id HAVING count(*) >= 2)
SELECT '{DAY}' AS day, coalesce(sum(n), 0)::BIGINT AS records, count(*) AS entities FROM t""")
def summary(spark, sf):
    return trails.day_summary(trail_day(spark, sf), DAY)


@query("u5_all_days_trails", f"""
WITH d AS (SELECT CAST(unnest(generate_series((SELECT min(ts)::DATE - 2 FROM events), (SELECT max(ts)::DATE + 2 FROM events), INTERVAL 1 DAY)) AS DATE) AS day)
SELECT strftime(day, '%Y-%m-%d') AS day, user_id, string_agg({_POINT}, ';' ORDER BY ts, event_id) AS trail, count(*)::INT AS point_count
FROM d JOIN events ON ts >= day - INTERVAL 9 HOUR AND ts < day + INTERVAL 17 HOUR GROUP BY day, user_id HAVING count(*) >= 2""")
def all_days(spark, sf):
    """Backfill of a range: a point near midnight belongs to both days, by arithmetic and not by a range join."""
    ev = table(spark, sf, "events")
    days = F.array_distinct(F.array(*[F.to_date(tu.shifted(F.col("ts"), tu.OFFSET_HOURS + h)) for h in (-1, 1)]))
    # the second bound is exclusive at one hour ahead: shifting by +1 h reaches the next day from 23:00 on
    rows = ev.withColumn("day", F.explode(days))
    agg = rows.groupBy("day", "user_id").agg(trails.packed(_order(), _point()).alias("trail"), F.count(F.lit(1)).cast("int").alias("point_count"))
    return agg.filter("point_count >= 2").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("g3_j1_timeline", """
SELECT l_partkey, max(p_name) AS part_name, max(p_brand) AS brand,
       string_agg(strftime(l_shipdate, '%Y%m%d') || ',' || coalesce(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), '0') || ',' || coalesce(l_returnflag, ''), ';' ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity, l_returnflag) AS timeline,
       count(*) AS point_count
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_partkey""")
def timeline(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    text = F.concat_ws(",", F.date_format("l_shipdate", "yyyyMMdd"), F.coalesce(F.col("l_quantity").cast("long").cast("string"), F.lit("0")), F.coalesce("l_returnflag", F.lit("")))
    # aggregate first: the join then meets one row a key
    agg = li.groupBy("l_partkey").agg(trails.packed([F.col("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity"), F.col("l_returnflag")], text).alias("timeline"), F.count(F.lit(1)).alias("point_count"))
    return agg.join(p, F.col("l_partkey") == F.col("p_partkey")).select("l_partkey", F.col("p_name").alias("part_name"), F.col("p_brand").alias("brand"), "timeline", "point_count")


@query("g4_frames", """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS observed, count(*)::INT AS cell_count,
       string_agg(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY o_custkey, o_orderkey) AS vals
FROM orders GROUP BY o_orderdate""")
def frames(spark, sf):
    o = table(spark, sf, "orders")
    vals = trails.packed([F.col("o_custkey"), F.col("o_orderkey")], F.round(F.col("o_totalprice") * 100).cast("long").cast("string"), ",")
    return o.groupBy("o_orderdate").agg(F.count(F.lit(1)).cast("int").alias("cell_count"), vals.alias("vals")).select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("observed"), "cell_count", "vals")


_CELLS = "SELECT user_id, 7 AS resolution, 'a' || (user_id % 20) AS cell FROM (SELECT DISTINCT user_id FROM events) UNION ALL SELECT user_id, 8, 'b' || (user_id % 45) FROM (SELECT DISTINCT user_id FROM events)"
_BUCKET = "strftime(time_bucket(INTERVAL 15 MINUTE, ts + INTERVAL 8 HOUR), '%Y-%m-%dT%H:%M')"
_QUARTERS = f"""
WITH m AS ({_CELLS}), q AS (
  SELECT resolution, cell, {_BUCKET} AS time_key, CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS DOUBLE) / nullif(sum(CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END), 0) AS fullness,
         avg(CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END) AS avg_total
  FROM events JOIN m USING (user_id) GROUP BY ALL)
"""


def _quarters(spark, sf):
    ev = table(spark, sf, "events")
    users = ev.select("user_id").distinct()
    cells = users.select("user_id", F.lit(7).alias("resolution"), F.concat(F.lit("a"), (F.col("user_id") % 20).cast("string")).alias("cell")).union(
        users.select("user_id", F.lit(8), F.concat(F.lit("b"), (F.col("user_id") % 45).cast("string")))
    )
    marked = ev.withColumns({"part": (F.col("event_type") == "view").cast("int"), "whole": F.col("event_type").isin("view", "click").cast("int")})
    return trails.bucket_cells(marked, cells, "user_id", "ts", "part", "whole")


@query("g5_j2_f4_bucket_ratio", _QUARTERS + "SELECT resolution, cell, time_key, round(fullness, 4) AS fullness, round(avg_total, 4) AS avg_total FROM q WHERE fullness IS NOT NULL")
def bucket_ratio(spark, sf):
    return _quarters(spark, sf).withColumns({"fullness": F.round("fullness", 4), "avg_total": F.round("avg_total", 4)})


@query("g6_x16_cell_frames", _QUARTERS + """
SELECT resolution, time_key, count(*) AS n_cells, '[' || string_agg('{"h":"' || cell || '","fr":' || CAST(round(CAST(fullness AS DECIMAL(20,10)), 4) AS DECIMAL(20,4)) || ',"sc":' || CAST(round(CAST(avg_total AS DECIMAL(20,10)), 1) AS DECIMAL(20,1)) || '}', ',' ORDER BY cell) || ']' AS cells
FROM q WHERE fullness IS NOT NULL GROUP BY resolution, time_key""")
def cell_frames(spark, sf):
    return trails.cell_frames(_quarters(spark, sf))


@query("g7_f3_dates", """
SELECT strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS date, count(DISTINCT user_id) AS frames, count(*) AS cells FROM events GROUP BY 1""")
def dates(spark, sf):
    ev = table(spark, sf, "events")
    return ev.groupBy(F.date_format(tu.local_time(F.col("ts")), "yyyy-MM-dd").alias("date")).agg(F.count_distinct("user_id").alias("frames"), F.count(F.lit(1)).alias("cells"))


@query("p13_o1_overlap_day", """
WITH s AS (SELECT l_orderkey, max(l_shipdate) AS expires FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS effective, strftime(coalesce(expires, o_orderdate), '%Y-%m-%d') AS until
FROM orders LEFT JOIN s ON o_orderkey = l_orderkey
WHERE o_orderdate < TIMESTAMP '1996-03-02' AND coalesce(expires, o_orderdate) >= TIMESTAMP '1996-03-01' AND o_orderstatus IS DISTINCT FROM 'P'""")
def overlap_day(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    end, start = (F.lit(f"1996-03-0{d} 00:00:00").cast("timestamp_ntz") for d in (2, 1))
    s = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("expires"))
    rows = o.filter((F.col("o_orderdate") < end) & ~F.col("o_orderstatus").eqNullSafe("P")).join(s, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    until = F.coalesce("expires", "o_orderdate")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return rows.filter(until >= start).orderBy(until, "o_orderkey").select("o_orderkey", day("o_orderdate").alias("effective"), day(until).alias("until"))


@query("p14_thinning", f"SELECT event_id FROM events WHERE ({_EPOCH} // 60) % 10 = 0")
def thinning(spark, sf):
    return table(spark, sf, "events").filter(tu.thinned(F.col("ts"), 10)).select("event_id")


@query("j13_o6_latest_snapshot", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def latest_snapshot(spark, sf):
    o = table(spark, sf, "orders")
    newest = o.agg(F.max("o_orderdate").alias("o_orderdate"))  # one row
    return o.join(F.broadcast(newest), "o_orderdate").select("o_orderkey", "o_custkey")


@query("s14_s21_latest_pointer", "SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id, strftime(max(ts), '%Y-%m-%d') AS dt FROM events GROUP BY user_id")
def latest_pointer(spark, sf):
    ev = table(spark, sf, "events")
    return ev.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.date_format(F.max("ts"), "yyyy-MM-dd").alias("dt"))


@query("s23_keyset_page", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE (l_orderkey, l_linenumber) > (1000, 2) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 500""")
def keyset_page(spark, sf):
    """A page is the feature here: the rows after a key, in key order."""
    k = F.col("l_orderkey")
    after = (k > 1000) | ((k == 1000) & (F.col("l_linenumber") > 2))
    return table(spark, sf, "lineitem").filter(after).orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").limit(500).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("g16_grid_stats", """
SELECT l_suppkey, round(min(l_quantity), 4) AS lo, round(max(l_quantity), 4) AS hi, round(avg(CAST(l_quantity AS DECIMAL(18,4))), 4)::DOUBLE AS mean, round(stddev_pop(l_quantity), 4) AS sd FROM lineitem GROUP BY l_suppkey""")
def grid_stats(spark, sf):
    q = F.col("l_quantity")
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.round(F.min(q), 4).alias("lo"), F.round(F.max(q), 4).alias("hi"), F.round(F.avg(q), 4).alias("mean"), F.round(F.stddev_pop(q), 4).alias("sd"))


@query("p3_s20_grid_unnest", """
WITH g AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
SELECT vec_id, (i // 8)::INT AS r, (i % 8)::INT AS c, round(21.0 + 0.03 * (i // 8), 4) AS lat, round(119.0 + 0.03 * (i % 8), 4) AS lng, CAST(round(v * 1000) AS BIGINT) AS milli
FROM g WHERE v > -0.9""")
def grid_unnest(spark, sf):
    """64 values as an 8 x 8 grid: array of rows, exploded twice. Products stay in 32 bits, as the values are."""
    e = table(spark, sf, "embeddings")
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: F.slice("embedding", r * 8 + 1, F.lit(8)))
    cells = e.select("vec_id", F.posexplode(rows).alias("r", "row")).select("vec_id", "r", F.posexplode("row").alias("c", "v")).filter(F.col("v") > F.lit(-0.9).cast("float"))
    return cells.select("vec_id", "r", "c", F.round(F.lit(21.0) + F.lit(0.03) * F.col("r"), 4).alias("lat"), F.round(F.lit(119.0) + F.lit(0.03) * F.col("c"), 4).alias("lng"), F.round(F.col("v") * F.lit(1000).cast("float")).cast("long").alias("milli"))
