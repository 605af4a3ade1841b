"""Queries: joins, sets and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwharf.functions import text as tx
from sparkwharf.functions import timeutil as tu
from sparkwharf.operators import lookups
from sparkwharf.operators import statistics as st
from sparkwharf.plans.register import query, table


@query("j3_const_predicate", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING'")
def const_predicate(spark, sf):
    c = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'")
    return table(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("j4_resolve_priority", """
WITH a AS (SELECT o_custkey AS k, max(o_orderpriority) AS v FROM orders WHERE o_orderstatus = 'O' GROUP BY 1), b AS (SELECT o_custkey AS k, min(o_orderpriority) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c_custkey, coalesce(CASE WHEN c_custkey % 10 = 0 THEN c_mktsegment END, a.v, b.v) AS value FROM customer LEFT JOIN a ON a.k = c_custkey LEFT JOIN b ON b.k = c_custkey""")
def resolve_priority(spark, sf):
    o = table(spark, sf, "orders")
    a = o.filter("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.max("o_orderpriority"))
    b = o.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.min("o_orderpriority"))
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 10 == 0, F.col("c_mktsegment")).alias("own"))
    return lookups.resolve_by_priority(c, "c_custkey", "own", a, b).select("c_custkey", "value")


@query("j5_u6_bounds", "SELECT event_id, day FROM events JOIN (VALUES ('a', TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-04'), ('b', TIMESTAMP '2024-01-04', TIMESTAMP '2024-01-06')) AS v(day, lo, hi) ON ts >= lo AND ts < hi")
def bounds(spark, sf):
    """Days as literals: two pruned scans and no join at all."""
    ev, at = table(spark, sf, "events"), lambda d: F.lit(f"2024-01-{d} 00:00:00").cast("timestamp_ntz")
    parts = [ev.filter((F.col("ts") >= at(lo)) & (F.col("ts") < at(hi))).select("event_id", F.lit(day).alias("day")) for day, lo, hi in (("a", "03", "04"), ("b", "04", "06"))]
    return parts[0].unionByName(parts[1])


@query("j6_f13_g13_tokens", r"""
WITH t AS (SELECT p_partkey, trim(unnest(regexp_split_to_array(p_name || '/' || p_type, '\s*[ /,;]\s*'))) AS tok, p_brand FROM part), d AS (SELECT DISTINCT p_brand AS brand, split_part(p_name, ' ', 1) AS tok FROM part WHERE p_partkey % 7 = 0)
SELECT p_partkey, count(DISTINCT brand) AS n_brands, coalesce(array_to_string(list_sort(list(DISTINCT tok)), '|'), '') AS toks FROM t JOIN d USING (tok) WHERE tok <> '' GROUP BY p_partkey""")
def token_join(spark, sf):
    p = table(spark, sf, "part")
    words = F.filter(F.transform(F.split(F.concat_ws("/", "p_name", "p_type"), r"\s*[ /,;]\s*"), F.trim), lambda x: x != "")
    t = p.select("p_partkey", F.explode(words).alias("tok"))
    d = p.filter("p_partkey % 7 = 0").select(F.col("p_brand").alias("brand"), F.get(F.split("p_name", " "), F.lit(0)).alias("tok")).distinct()
    return t.join(d, "tok").groupBy("p_partkey").agg(F.count_distinct("brand").alias("n_brands"), F.array_join(F.array_sort(F.collect_set("tok")), "|").alias("toks"))


@query("j10_j11_anti_semi", """
SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def anti_semi(spark, sf):
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'")
    rich = table(spark, sf, "customer").filter("c_acctbal > 0")
    o = table(spark, sf, "orders")
    return o.join(returned, o.o_orderkey == returned.l_orderkey, "left_anti").join(rich, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")


@query("j12_correlated_count", "SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS n FROM customer")
def correlated(spark, sf):
    per = table(spark, sf, "orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return table(spark, sf, "customer").select("c_custkey").join(per, "c_custkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("j14_x8_p9_boxes", """
WITH p AS (SELECT event_id, 121 + (event_id % 89) / 1000.0::DOUBLE AS lng, 24 + (event_id % 97) / 1000.0::DOUBLE AS lat FROM events),
b AS (SELECT s_suppkey, 121 + (s_suppkey * 7 % 89) / 1000.0::DOUBLE AS west, 24 + (s_suppkey * 11 % 97) / 1000.0::DOUBLE AS south FROM supplier),
m AS (SELECT event_id, s_suppkey FROM p JOIN b ON lng BETWEEN west AND west + 0.0045 AND lat BETWEEN south AND south + 0.0035)
SELECT event_id, array_to_string(list_sort(list(s_suppkey) FILTER (s_suppkey IS NOT NULL)), ',') AS zones FROM p LEFT JOIN m USING (event_id) GROUP BY event_id""")
def boxes(spark, sf):
    p = table(spark, sf, "events").select("event_id", (F.lit(121.0) + (F.col("event_id") % 89) / F.lit(1000.0)).alias("lng"), (F.lit(24.0) + (F.col("event_id") % 97) / F.lit(1000.0)).alias("lat"))
    k = F.col("s_suppkey")
    b = table(spark, sf, "supplier").select(k, (F.lit(121.0) + (k * 7 % 89) / F.lit(1000.0)).alias("west"), (F.lit(24.0) + (k * 11 % 97) / F.lit(1000.0)).alias("south"))
    b = b.withColumns({"east": F.col("west") + 0.0045, "north": F.col("south") + 0.0035})
    # a place is looked up once, however many events are there
    zones = lookups.in_boxes(p.select("lng", "lat").distinct(), b, 0.005).groupBy("lng", "lat").agg(F.array_join(F.array_sort(F.collect_list("s_suppkey")), ",").alias("zones"))
    return p.join(zones, ["lng", "lat"], "left").select("event_id", "zones")


@query("j15_range_sections", """
WITH s AS (SELECT 'r' || (p_partkey % 5) AS road, CASE WHEN p_partkey % 2 = 0 THEN 'N' ELSE 'S' END AS dir, (p_partkey * 3 % 1000)::DOUBLE AS low, (p_partkey * 3 % 1000 + p_size % 5)::DOUBLE AS high, p_partkey AS section FROM part),
p AS (SELECT event_id AS id, 'r' || (event_id % 6) AS road, CASE event_id % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'S' WHEN 2 THEN 'B' ELSE 'X' END AS dir, (event_id * 7 % 1100)::DOUBLE AS km FROM events),
w AS (SELECT p.*, CASE WHEN dir <> 'B' AND EXISTS (SELECT 1 FROM s WHERE s.road = p.road AND s.dir = p.dir) THEN dir END AS want, EXISTS (SELECT 1 FROM s WHERE s.road = p.road) AS has_road FROM p),
h AS (SELECT id, count(*) AS hits, min_by(section, (low, section)) AS section FROM w JOIN s ON s.road = w.road AND (want IS NULL OR s.dir = want) AND km BETWEEN low AND high GROUP BY id)
SELECT id, CASE WHEN NOT has_road THEN 'no_section' WHEN hits IS NULL THEN 'km_out' WHEN hits = 1 THEN 'matched' ELSE 'multi_match' END AS status, section FROM w LEFT JOIN h USING (id)""")
def sections(spark, sf):
    k, e = F.col("p_partkey"), F.col("event_id")
    road = lambda c, n: F.concat(F.lit("r"), (c % n).cast("string"))
    s = table(spark, sf, "part").select(road(k, 5).alias("road"), F.when(k % 2 == 0, "N").otherwise("S").alias("dir"), (k * 3 % 1000).cast("double").alias("low"), (k * 3 % 1000 + F.col("p_size") % 5).cast("double").alias("high"), k.alias("section"))
    p = table(spark, sf, "events").select(e.alias("id"), road(e, 6).alias("road"), F.element_at(F.array(*map(F.lit, "NSBX")), (e % 4 + 1).cast("int")).alias("dir"), (e * 7 % 1100).cast("double").alias("km"))
    return lookups.match_sections(p, s, 5.0)


@query("j16_as_of", """
WITH h AS (SELECT user_id, ts AS since, event_id AS ver FROM events WHERE event_type = 'view'), p AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase')
SELECT p.event_id, CASE WHEN since >= ts - INTERVAL 2 DAY THEN ver END AS ver FROM p ASOF LEFT JOIN h ON p.user_id = h.user_id AND p.ts >= h.since""")
def as_of(spark, sf):
    ev = table(spark, sf, "events")
    h = ev.filter("event_type = 'view'").select("user_id", F.col("ts").alias("since"), F.col("event_id").alias("ver"))
    p = ev.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    return lookups.as_of(p, h, ["user_id"], "ts", "since", F.expr("INTERVAL 2 DAYS")).select("event_id", "ver")


@query("j18_first_category", """
SELECT p_partkey, coalesce(CASE split_part(p_type, ' ', 1) WHEN 'ECONOMY' THEN 'low' WHEN 'PROMO' THEN 'offer' WHEN 'STANDARD' THEN 'mid' END, 'other') AS category FROM part""")
def first_category(spark, sf):
    names = spark.createDataFrame([("ECONOMY", "low"), ("PROMO", "offer"), ("STANDARD", "mid")], "word string, category string")
    p = table(spark, sf, "part").select("p_partkey", F.element_at(F.split("p_type", " "), 1).alias("word"))
    return p.join(F.broadcast(names), "word", "left").select("p_partkey", F.coalesce("category", F.lit("other")).alias("category"))


@query("j19_degrade", """
WITH g AS (SELECT DISTINCT lpad(CAST(n_nationkey * 100003 % 100000 AS VARCHAR), 8, 'A') AS code FROM nation WHERE n_nationkey % 2 = 0), r AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'AAA' || (c_custkey % 9) ELSE lpad(CAST(c_nationkey * 100003 % 100000 AS VARCHAR), 8, CASE WHEN c_custkey % 3 = 1 THEN 'A' ELSE 'B' END) END AS code FROM customer)
SELECT c_custkey, CASE WHEN code IN (SELECT code FROM g) THEN code WHEN left(code, 3) IN (SELECT left(code, 3) FROM g) THEN left(code, 3) END AS resolved FROM r""")
def degrade(spark, sf):
    code = lambda c, pad: F.lpad((c * 100003 % 100000).cast("string"), 8, pad)
    g = table(spark, sf, "nation").filter("n_nationkey % 2 = 0").select(code(F.col("n_nationkey"), "A").alias("code"))
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    own = F.when(k % 3 == 0, F.concat(F.lit("AAA"), (k % 9).cast("string"))).when(k % 3 == 1, code(n, "A")).otherwise(code(n, "B"))
    return lookups.degrade(table(spark, sf, "customer").select("c_custkey", own.alias("code")), g, "code").select("c_custkey", "resolved")


@query("j20_o8_tracks", """
WITH tr AS (SELECT (CASE p_partkey % 4 WHEN 0 THEN 'OD-' WHEN 1 THEN 'SP-' WHEN 2 THEN 'BB-' ELSE 'ZZ-' END) || p_partkey AS track, p_partkey % 11 AS a, p_partkey % 7 + 21 AS b, p_partkey AS k FROM part),
ts AS (SELECT track, unnest([a, a + 1, a + 3, b]) AS station, unnest([0, 1 + k % 3, 2, 4]) AS progress, a, b FROM tr),
w AS (SELECT o_orderkey, o_orderkey % 77 AS trip FROM orders), t AS (SELECT DISTINCT o_orderkey % 77 AS trip, o_orderkey % 11 AS o, o_orderkey % 7 + 21 AS d, [o_orderkey % 11, o_orderkey % 11 + 1, o_orderkey % 11 + 3, o_orderkey % 7 + 21] AS stops FROM orders),
l AS (SELECT trip, o, d, len(stops) AS n, unnest(stops) AS station, generate_subscripts(stops, 1) AS i FROM t),
j AS (SELECT *, progress - lag(progress) OVER (PARTITION BY trip, track ORDER BY i) AS step FROM l JOIN ts USING (station)),
s AS (SELECT trip, track, count(*) FILTER (step > 0) AS up, count(*) FILTER (step < 0) AS down, count(DISTINCT station) / any_value(n)::DOUBLE AS cover, bool_or(a = o AND b = d) AS exact, max(CASE WHEN station = o THEN progress END) AS p0, max(CASE WHEN station = d THEN progress END) AS p1 FROM j GROUP BY ALL),
r AS (SELECT trip, track FROM s WHERE exact OR p0 < p1 QUALIFY row_number() OVER (PARTITION BY trip ORDER BY NOT exact, CASE WHEN up + down > 0 THEN down / (up + down)::DOUBLE ELSE 0 END, -cover, CASE left(track, 3) WHEN 'OD-' THEN 0 WHEN 'SP-' THEN 1 WHEN 'BB-' THEN 2 ELSE 3 END, track) = 1)
SELECT o_orderkey AS trip, track FROM w JOIN r USING (trip)""")
def tracks(spark, sf):
    p, orders = table(spark, sf, "part"), table(spark, sf, "orders")
    k, o = F.col("p_partkey"), F.col("o_orderkey")
    name = F.concat(F.element_at(F.array(*map(F.lit, ("OD-", "SP-", "BB-", "ZZ-"))), (k % 4 + 1).cast("int")), k.cast("string"))
    base = p.select(name.alias("track"), (k % 11).alias("origin"), (k % 7 + 21).alias("dest"), F.arrays_zip(F.array(k % 11, k % 11 + 1, k % 11 + 3, k % 7 + 21).alias("station"), F.array(F.lit(0).cast("long"), 1 + k % 3, F.lit(2).cast("long"), F.lit(4).cast("long")).alias("progress")).alias("s"))
    tr = base.select("track", "origin", "dest", F.explode("s").alias("s")).select("track", "origin", "dest", "s.station", "s.progress")
    t = orders.select(o.alias("trip"), (o % 11).alias("origin"), (o % 7 + 21).alias("dest"), F.array(o % 11, o % 11 + 1, o % 11 + 3, o % 7 + 21).alias("stops"))
    return lookups.match_tracks(t, tr)


@query("j21_three_layers", """
WITH a AS (SELECT user_id, max(ts) >= TIMESTAMP '2024-01-29' AS a FROM events GROUP BY 1), b AS (SELECT user_id, count(*) > 0 AS b FROM events WHERE ts >= TIMESTAMP '2024-01-28' GROUP BY 1), c AS (SELECT user_id, max(ts) >= TIMESTAMP '2024-01-27' AS c FROM events WHERE event_type = 'purchase' GROUP BY 1), u AS (SELECT DISTINCT user_id FROM events)
SELECT user_id, (CASE WHEN a THEN 'A' ELSE 'a' END) || (CASE WHEN coalesce(b, FALSE) THEN 'B' ELSE 'b' END) || (CASE WHEN coalesce(c, FALSE) THEN 'C' ELSE 'c' END) AS flags FROM u LEFT JOIN a USING (user_id) LEFT JOIN b USING (user_id) LEFT JOIN c USING (user_id)""")
def three_layers(spark, sf):
    """All three layers read one table here, so one conditional aggregate replaces three joins."""
    at = lambda d: F.lit(f"2024-01-{d} 00:00:00").cast("timestamp_ntz")
    mark = lambda c, x: F.when(F.coalesce(c, F.lit(False)), x).otherwise(x.lower())
    agg = table(spark, sf, "events").groupBy("user_id").agg((F.max("ts") >= at("29")).alias("a"), (F.count_if(F.col("ts") >= at("28")) > 0).alias("b"), (F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))) >= at("27")).alias("c"))
    return agg.select("user_id", F.concat(mark(F.col("a"), "A"), mark(F.col("b"), "B"), mark(F.col("c"), "C")).alias("flags"))


@query("j22_m10_reconcile", """
WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1)
SELECT k, a.n AS a, b.n AS b, CASE WHEN b.n IS NULL THEN 'only_a' WHEN a.n IS NULL THEN 'only_b' WHEN a.n <> b.n THEN 'differs' ELSE 'ok' END AS state FROM a FULL JOIN b USING (k)""")
def reconcile(spark, sf):
    per = lambda cond: table(spark, sf, "orders").filter(cond).groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return lookups.reconcile(per("o_orderstatus <> 'P'"), per("o_orderpriority <> '1-URGENT'"), ["k"], "n")


@query("j23_known_events", "SELECT event_id FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE event_type = 'view')")
def known_events(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id").join(ev.filter("event_type = 'view'").select("event_id"), "event_id", "left_anti")


@query("u1_u3_union_distinct", "SELECT c_nationkey AS n FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("n")).union(table(spark, sf, "supplier").select("s_nationkey")).distinct()


@query("u2_except", "SELECT c_nationkey AS n FROM customer EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey = 1")
def except_(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("n")).subtract(table(spark, sf, "nation").filter("n_regionkey = 1").select("n_nationkey"))


@query("u7_m9_drift", """
WITH a AS (SELECT DISTINCT p_brand AS k FROM part WHERE p_size < 5), b AS (SELECT DISTINCT p_brand AS k FROM part WHERE p_size > 48)
SELECT k, 'missing' AS side FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, 'orphan' FROM b WHERE k NOT IN (SELECT k FROM a)""")
def drift(spark, sf):
    p = table(spark, sf, "part")
    a, b = (p.filter(c).select(F.col("p_brand").alias("k")).distinct() for c in ("p_size < 5", "p_size > 48"))
    return a.join(b, "k", "left_anti").withColumn("side", F.lit("missing")).unionByName(b.join(a, "k", "left_anti").withColumn("side", F.lit("orphan")))


@query("u8_t12_anomaly_diff", """
WITH a AS (SELECT DISTINCT user_id FROM events WHERE value > 95 AND ts < TIMESTAMP '2024-01-15'), b AS (SELECT DISTINCT user_id FROM events WHERE value > 95 AND ts >= TIMESTAMP '2024-01-15')
SELECT user_id, CASE WHEN a.user_id IS NULL THEN 'new' WHEN b.user_id IS NULL THEN 'resolved' ELSE 'persistent' END AS state FROM a FULL JOIN b USING (user_id)""")
def anomaly_diff(spark, sf):
    late = F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    agg = table(spark, sf, "events").filter("value > 95").groupBy("user_id").agg(F.bool_or(~late).alias("before"), F.bool_or(late).alias("now"))
    return agg.select("user_id", F.when(~F.col("before"), "new").when(~F.col("now"), "resolved").otherwise("persistent").alias("state"))


@query("o3_o4_null_order", """
SELECT k, r::INT AS r FROM (SELECT c_custkey AS k, row_number() OVER (ORDER BY CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END ASC NULLS LAST, c_acctbal IS NULL DESC, c_custkey) AS r FROM customer)""")
def null_order(spark, sf):
    """A global rank without one big partition: ranks inside ranges plus the sizes of the ranges before."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("s"), F.col("c_acctbal").isNull().alias("none"))
    return st.global_rank(c, [F.col("s").asc_nulls_last(), F.col("none").desc(), F.col("k")], "r").select("k", F.col("r").cast("int").alias("r"))


@query("o5_g18_top", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 10")
def top(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l_suppkey").limit(10)


@query("p31_worklist", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority IS NULL OR o_totalprice IS NULL ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 50")
def worklist(spark, sf):
    o = table(spark, sf, "orders").filter((F.col("o_orderstatus") == "P") | F.col("o_orderpriority").isNull() | F.col("o_totalprice").isNull())
    return o.orderBy(F.col("o_orderdate").desc_nulls_last(), "o_orderkey").limit(50).select("o_orderkey")
