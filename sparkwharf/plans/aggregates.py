"""Queries: aggregations and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwharf.operators import statistics as st
from sparkwharf.plans.register import query, table


@query("g11_having_distinct", "SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_returnflag) = 1 AND count(*) > 1")
def having_distinct(spark, sf):
    # extremes equal means one distinct value, without a second shuffle
    agg = table(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.min("l_returnflag").alias("a"), F.max("l_returnflag").alias("b"))
    return agg.filter("a = b AND n > 1").drop("a", "b")


@query("g12_count_filter", "SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) AS n FROM orders GROUP BY 1")
def count_filter(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count(F.lit(1)).alias("n"))


@query("g13_f34_array_agg", "SELECT s_nationkey, coalesce(array_to_string(list_sort(list(DISTINCT CASE WHEN s_acctbal > 0 THEN s_name END) FILTER (s_acctbal > 0)), ','), '') AS names FROM supplier GROUP BY 1")
def array_agg(spark, sf):
    return table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.array_join(F.array_sort(F.collect_set(F.when(F.col("s_acctbal") > 0, F.col("s_name")))), ",").alias("names"))


@query("g14_conditional_sums", """
SELECT l_returnflag, sum(CASE WHEN l_shipdate >= TIMESTAMP '1996-01-01' THEN 1 ELSE 0 END)::BIGINT AS late, CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS open_qty, max(date_diff('day', TIMESTAMP '1992-01-01', l_shipdate)) AS most_days FROM lineitem GROUP BY 1""")
def conditional_sums(spark, sf):
    late = F.col("l_shipdate") >= F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    days = F.max(F.datediff(F.to_date("l_shipdate"), F.lit("1992-01-01").cast("date"))).cast("long")
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count_if(late).alias("late"), F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("long")).otherwise(0)).alias("open_qty"), days.alias("most_days"))


@query("g17_detectors", """
WITH l AS (SELECT l_suppkey, CASE WHEN l_returnflag = 'R' THEN 'L' ELSE 'S' END AS kind, CAST(l_quantity AS BIGINT) - 5 AS volume, CAST(l_quantity AS BIGINT) - 10 AS speed, CAST(round(l_discount * 100) AS BIGINT) - 2 AS occupancy FROM lineitem)
SELECT l_suppkey, CAST(sum(CASE WHEN kind = 'S' AND volume > 0 THEN volume ELSE 0 END) AS BIGINT) AS small, CAST(sum(CASE WHEN kind = 'L' AND volume > 0 THEN volume ELSE 0 END) AS BIGINT) AS large,
round(coalesce(avg(CASE WHEN speed > 0 THEN speed END), 0), 6) AS speed, round(coalesce(avg(CASE WHEN occupancy >= 0 THEN occupancy END), 0), 6) AS occupancy FROM l GROUP BY 1""")
def detectors(spark, sf):
    q = F.col("l_quantity").cast("long")
    lanes = table(spark, sf, "lineitem").select("l_suppkey", F.when(F.col("l_returnflag") == "R", "L").otherwise("S").alias("kind"), (q - 5).alias("volume"), (q - 10).alias("speed"), (F.round(F.col("l_discount") * 100).cast("long") - 2).alias("occupancy"))
    return st.detector_rollup(lanes, ["l_suppkey"]).withColumns({"speed": F.round("speed", 6), "occupancy": F.round("occupancy", 6)})


@query("g19_skip_nulls", "SELECT c_nationkey, count(*) AS n, round(avg(CASE WHEN c_acctbal > -99 THEN CAST(round(c_acctbal * 100) AS BIGINT) END), 4) AS mean FROM customer GROUP BY 1")
def skip_nulls(spark, sf):
    cents = F.round(F.col("c_acctbal") * 100).cast("long")
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.when(F.col("c_acctbal") > -99, cents)), 4).alias("mean"))


@query("g20_f38_lots", """
WITH l AS (SELECT p_brand, p_size AS total, (p_partkey % 60 - 1)::INT AS free FROM part)
SELECT p_brand, coalesce(sum(CASE WHEN free >= 0 THEN free END), 0)::BIGINT AS free, count(*) FILTER (free = 0) AS "full", count(*) FILTER (free > 0 AND free * 10 < total) AS tight, round(avg(CASE WHEN total > 0 AND free >= 0 THEN round(1.0::DOUBLE - free / total::DOUBLE, 3) END), 4) AS mean_occupancy FROM l GROUP BY 1""")
def lots(spark, sf):
    return st.lots_rollup(table(spark, sf, "part").select("p_brand", F.col("p_size").alias("total"), (F.col("p_partkey") % 60 - 1).cast("int").alias("free")), ["p_brand"])


@query("g21_name_diversity", """
WITH p AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), a AS (SELECT user_id, count(*) AS names, max(n) AS most, sum(n) AS total, max_by(event_type, (n, event_type)) AS main FROM p GROUP BY 1)
SELECT user_id, names, main FROM a WHERE names > 3 AND most < 0.3 * total""")
def diversity(spark, sf):
    return st.name_diversity(table(spark, sf, "events"), "user_id", "event_type", 3, 0.3)


@query("g25_fingerprint", "SELECT count(*) || '|' || strftime(max(coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate END, o_orderdate)), '%Y-%m-%d') AS fingerprint FROM orders")
def table_fingerprint(spark, sf):
    o = table(spark, sf, "orders").withColumn("updated", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate")))
    return st.fingerprint(o, "updated", "o_orderdate")


@query("g26_g34_digest", """
WITH c AS (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings), d AS (SELECT label, CASE WHEN i % 5 = 0 OR label = 3 THEN NULL ELSE v END AS v FROM c)
SELECT label, round(max(v), 6) AS "max", round(min(v), 6) AS "min", round(avg(v), 4) AS mean, count(v) AS n, count(*) - count(v) AS nan_count FROM d GROUP BY 1""")
def digest(spark, sf):
    c = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    c = c.withColumn("v", F.when(((F.col("i") + 1) % 5 == 0) | (F.col("label") == 3), F.lit(float("nan"))).otherwise(F.col("v").cast("double")))
    return st.raster_digest(c, ["label"], "v").withColumns({"max": F.round("max", 6), "min": F.round("min", 6)})


@query("g28_coverage", "SELECT round(count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders)) / count(*)::DOUBLE, 6) AS ratio, count(*) AS n FROM customer")
def coverage(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    hit = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("hit", F.lit(True))
    return c.join(hit, "c_custkey", "left").agg(F.round(F.count("hit") / F.count(F.lit(1)), 6).alias("ratio"), F.count(F.lit(1)).alias("n"))


@query("g30_displacement", "SELECT user_id, CASE WHEN max(event_id) - min(event_id) < 300 THEN 'still' WHEN max(event_id) - min(event_id) < 2000 THEN 'near' ELSE 'moving' END AS moved FROM events GROUP BY 1")
def displacement(spark, sf):
    return st.displacement_class(table(spark, sf, "events"), "user_id", F.col("event_id"))


@query("g31_g32_latest", "SELECT event_type, max(strftime(ts, '%Y-%m-%d')) AS latest, max_by(user_id, (ts, event_id)) AS last_user, max(ts) < TIMESTAMP '2024-01-30' AS lost FROM events GROUP BY 1")
def latest(spark, sf):
    lost = F.max("ts") < F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    return table(spark, sf, "events").groupBy("event_type").agg(F.max(F.date_format("ts", "yyyy-MM-dd")).alias("latest"), F.max_by("user_id", F.struct("ts", "event_id")).alias("last_user"), lost.alias("lost"))


@query("g33_arg_max", "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY (event_type = 'purchase') DESC, CAST(round(value * 100) AS BIGINT) DESC, event_id) = 1")
def arg_max(spark, sf):
    rank = F.struct(F.col("event_type") == "purchase", F.round(F.col("value") * 100).cast("long"), -F.col("event_id"))
    return table(spark, sf, "events").groupBy("user_id").agg(F.max_by("event_id", rank).alias("event_id"))


@query("g35_upper_median", "SELECT l_suppkey, list_sort(list(CAST(l_quantity AS BIGINT)))[count(*) // 2 + 1] AS median, count(*) FILTER (l_discount <> 0) AS non_zero FROM lineitem GROUP BY 1")
def median(spark, sf):
    li = table(spark, sf, "lineitem")
    return st.upper_median(li, ["l_suppkey"], F.col("l_quantity").cast("long")).join(li.groupBy("l_suppkey").agg(F.count_if(F.col("l_discount") != 0).alias("non_zero")), "l_suppkey")


@query("p1_p7_json_fields", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_fields(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@query("p2_derived_total", "SELECT l_orderkey, l_linenumber, l_partkey, coalesce(CAST(CASE WHEN l_returnflag = 'N' THEN l_quantity END AS BIGINT), 0) + coalesce(CAST(l_tax * 100 AS BIGINT), 0) AS total FROM lineitem")
def derived_total(spark, sf):
    a, b = F.when(F.col("l_returnflag") == "N", F.col("l_quantity")).cast("long"), F.round(F.col("l_tax") * 100).cast("long")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))).alias("total"))


@query("p6_melt", """
SELECT l_orderkey, l_linenumber, l_partkey, unnest(['quantity', 'tax']) AS metric, unnest([CAST(l_quantity AS BIGINT), CAST(round(l_tax * 100) AS BIGINT)]) AS value FROM lineitem""")
def melt(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("quantity"), F.round(F.col("l_tax") * 100).cast("long").alias("tax"))
    return li.unpivot(["l_orderkey", "l_linenumber", "l_partkey"], ["quantity", "tax"], "metric", "value")


@query("p4_p5_nested_unnest", """
WITH a AS (SELECT o_custkey, list({k: o_orderkey, s: o_orderstatus} ORDER BY o_orderkey) AS os FROM orders GROUP BY 1) SELECT DISTINCT o_custkey, x.s AS s, x.k % 10 AS b FROM (SELECT o_custkey, unnest(os) AS x FROM a)""")
def nested(spark, sf):
    a = table(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))).alias("os"))
    return a.select("o_custkey", F.explode("os").alias("x")).select("o_custkey", "x.s", (F.col("x.k") % 10).alias("b")).dropDuplicates()


@query("p9_p10_boxes", "SELECT event_id, CASE WHEN (event_id % 97) BETWEEN 10 AND 50 THEN event_id % 97 END AS lat FROM events WHERE event_id % 89 BETWEEN 5 AND 80")
def box_filter(spark, sf):
    lat, lng = F.col("event_id") % 97, F.col("event_id") % 89
    return table(spark, sf, "events").filter(lng.between(5, 80)).select("event_id", F.when(lat.between(10, 50), lat).alias("lat"))


@query("p15_p16_p11_predicates", r"""
SELECT p_partkey FROM part WHERE (regexp_matches(p_brand, '[1-3]$') AND NOT regexp_matches(p_type, '^STANDARD')) OR p_name ILIKE '%A%E%' OR p_size IN (1, 7, 49)""")
def predicates(spark, sf):
    p = table(spark, sf, "part")
    return p.filter((F.col("p_brand").rlike("[1-3]$") & ~F.col("p_type").rlike("^STANDARD")) | F.col("p_name").ilike("%A%E%") | F.col("p_size").isin(1, 7, 49)).select("p_partkey")


@query("p19_p17_required", "SELECT p_partkey FROM part WHERE p_name IS NOT NULL AND p_brand <> '' AND NOT contains(p_type, 'PROMO')")
def required(spark, sf):
    return table(spark, sf, "part").filter(F.col("p_name").isNotNull() & (F.col("p_brand") != "") & ~F.contains("p_type", F.lit("PROMO"))).select("p_partkey")


@query("p20_all_zero_batch", "SELECT o_orderkey, coalesce(max(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey) = 0, TRUE) AS closed FROM orders")
def all_zero(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey")
    return table(spark, sf, "orders").select("o_orderkey", F.bool_and(F.col("o_orderstatus") == "F").over(w).alias("closed"))


@query("p21_p22_hours", """
SELECT event_id, hour(ts) >= 22 OR hour(ts) < 6 AS quiet, t IS NOT NULL AND isodow(t) <= 5 AND CAST(t AS TIME) BETWEEN TIME '09:00:00' AND TIME '13:30:00' AS market
FROM (SELECT event_id, ts, CASE event_id % 4 WHEN 0 THEN date_trunc('day', ts) + INTERVAL '13 hours 30 minutes' + to_seconds(event_id % 3) WHEN 1 THEN NULL ELSE ts END AS t FROM events)""")
def hours(spark, sf):
    from sparkwharf.operators import health

    # some rows at the closing time and a second or two behind it, some without a time
    k, closing = F.col("event_id"), F.date_trunc("day", "ts").cast("timestamp_ntz") + F.expr("INTERVAL '13:30:00' HOUR TO SECOND")
    at = F.when(k % 4 == 0, closing + F.make_dt_interval(secs=(k % 3).cast("decimal(18,6)"))).when(k % 4 > 1, F.col("ts"))
    return table(spark, sf, "events").select("event_id", health.quiet_hours(F.col("ts"), 22, 6).alias("quiet"), health.market_hours(at).alias("market"))


@query("p24_p25_classes", """
SELECT p_partkey, CASE WHEN p_type LIKE 'STANDARD%' THEN 's' WHEN p_size > 40 THEN 'big' WHEN p_size > 20 THEN 'mid' ELSE 'small' END AS class, CASE p_brand WHEN 'Brand#11' THEN 'eleven' WHEN 'Brand#12' THEN 'twelve' ELSE 'unknown' END AS label FROM part""")
def classes(spark, sf):
    from sparkwharf.functions.text import labelled

    cls = F.when(F.col("p_type").startswith("STANDARD"), "s").when(F.col("p_size") > 40, "big").when(F.col("p_size") > 20, "mid").otherwise("small")
    return table(spark, sf, "part").select("p_partkey", cls.alias("class"), labelled(F.col("p_brand"), {"Brand#11": "eleven", "Brand#12": "twelve"}, "unknown").alias("label"))


@query("p26_staleness", "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate - o_orderdate > INTERVAL 30 DAY AS stale FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def staleness(spark, sf):
    j = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_shipdate") > F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("stale"))


@query("p27_recent_years", "SELECT o_orderkey FROM orders WHERE year(o_orderdate) > (SELECT max(year(o_orderdate)) FROM orders) - 2")
def recent_years(spark, sf):
    o = table(spark, sf, "orders")
    newest = o.agg(F.max(F.year("o_orderdate")).alias("y"))  # one row
    return o.join(F.broadcast(newest), F.year("o_orderdate") > F.col("y") - 2).select("o_orderkey")


@query("p28_p30_struct_join", """
SELECT o_custkey, string_agg(o_orderstatus || o_orderkey, ', ' ORDER BY o_orderkey) AS names, CASE WHEN bool_or(o_orderstatus = 'P') THEN 'live' WHEN bool_and(o_orderstatus = 'F') THEN 'ended' ELSE 'upcoming' END AS state FROM orders GROUP BY 1""")
def struct_join(spark, sf):
    a = table(spark, sf, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("os"))
    some, every = F.exists("os", lambda x: x["o_orderstatus"] == "P"), F.forall("os", lambda x: x["o_orderstatus"] == "F")
    return a.select("o_custkey", F.array_join(F.transform("os", lambda x: F.concat(x["o_orderstatus"], x["o_orderkey"].cast("string"))), ", ").alias("names"), F.when(some, "live").when(every, "ended").otherwise("upcoming").alias("state"))
