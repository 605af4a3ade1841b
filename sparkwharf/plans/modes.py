"""Queries: write modes over customers and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwharf.operators import write_modes as wm
from sparkwharf.plans.register import query, table
from sparkwharf.sources.shared import folder

_CUR = "cur AS (SELECT c_custkey AS k, CAST(round(c_acctbal * 100) AS BIGINT) AS cents, c_mktsegment AS seg FROM customer WHERE c_custkey % 3 <> 0)"
_BATCH = "b AS (SELECT o_custkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderpriority AS seg, o_orderkey AS _seq FROM orders)"
_LAST = "l AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY k ORDER BY _seq DESC) = 1)"


def current(spark, sf):
    c = table(spark, sf, "customer").filter("c_custkey % 3 <> 0")
    return c.select(F.col("c_custkey").alias("k"), F.round(F.col("c_acctbal") * 100).cast("long").alias("cents"), F.col("c_mktsegment").alias("seg"))


def batch(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_custkey").alias("k"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"), F.col("o_orderpriority").alias("seg"), F.col("o_orderkey").alias("_seq"))


@query("k1_append", f"WITH {_CUR}, {_BATCH} SELECT k, cents, seg FROM cur UNION ALL SELECT k, cents, seg FROM b")
def append(spark, sf):
    return current(spark, sf).unionByName(batch(spark, sf).drop("_seq"))


@query("k2_upsert", f"WITH {_CUR}, {_BATCH}, {_LAST} SELECT k, cents, seg FROM l UNION ALL SELECT * FROM cur WHERE k NOT IN (SELECT k FROM l)")
def upsert(spark, sf):
    return wm.upsert(current(spark, sf), batch(spark, sf), ["k"])


@query("k4_k6_current_state", f"WITH {_BATCH}, {_LAST} SELECT k, cents, seg, '2024-02-01' AS touched FROM l")
def current_state(spark, sf):
    """The keyed snapshot of a feed; rows without a key are skipped."""
    b = batch(spark, sf)
    nulls = b.limit(0).select(F.lit(None).cast("long").alias("k"), "cents", "seg", "_seq")
    return wm.keep_last(b.unionByName(nulls), ["k"]).drop("_seq").withColumn("touched", F.lit("2024-02-01"))


@query("k3_insert_absent", f"WITH {_CUR}, {_BATCH}, f AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY k ORDER BY _seq) = 1) SELECT * FROM cur UNION ALL SELECT k, cents, seg FROM f WHERE k NOT IN (SELECT k FROM cur)")
def insert_absent(spark, sf):
    return wm.insert_new(current(spark, sf), batch(spark, sf), ["k"])


@query("k3_insert_two_keys", f"""
WITH {_CUR}, {_BATCH}, a AS (SELECT * FROM b WHERE k NOT IN (SELECT k FROM cur) AND cents NOT IN (SELECT cents FROM cur)),
f AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY k ORDER BY _seq) = 1), g AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY cents ORDER BY _seq) = 1)
SELECT * FROM cur UNION ALL SELECT k, cents, seg FROM g""")
def insert_two_keys(spark, sf):
    return wm.insert_new(current(spark, sf), batch(spark, sf), ["k"], ["cents"])


@query("k5_prune_stale", "WITH l AS (SELECT o_custkey AS k, max(o_orderdate) AS seen FROM orders GROUP BY 1) SELECT k, strftime(seen, '%Y-%m-%d') AS seen FROM l WHERE seen >= TIMESTAMP '1998-01-01'")
def prune(spark, sf):
    cur = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderdate").alias("seen"))
    return wm.prune_stale(cur, "seen", F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")).withColumn("seen", F.date_format("seen", "yyyy-MM-dd"))


@query("k8_p12_change_only", """
WITH cur AS (SELECT o_custkey AS k, o_orderpriority AS a, o_orderstatus AS b FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1),
n AS (SELECT o_custkey AS k, nullif(o_orderpriority, '5-LOW') AS a, o_orderstatus AS b FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
SELECT n.* FROM n LEFT JOIN cur USING (k) WHERE cur.k IS NULL OR n.a IS DISTINCT FROM cur.a OR n.b IS DISTINCT FROM cur.b""")
def change_only(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("a"), F.col("o_orderstatus").alias("b"), F.col("o_orderkey").alias("_seq"))
    cur, new = wm.keep_first(o, ["k"]).drop("_seq"), wm.keep_last(o, ["k"]).drop("_seq")
    return wm.changed_only(cur, new.withColumn("a", F.nullif(F.col("a"), F.lit("5-LOW"))), ["k"], ["a", "b"])


@query("k9_expire", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01'")
def expire(spark, sf):
    return wm.expire(table(spark, sf, "lineitem"), "l_shipdate", F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")).select("l_orderkey", "l_linenumber", "l_partkey")


@query("k7_fan_out", "SELECT event_type AS target, count(*) AS n, min(event_id) AS first FROM events WHERE event_type IN ('click', 'view') GROUP BY event_type")
def fan_out(spark, sf):
    parts = wm.fan_out(table(spark, sf, "events"), "event_type", ["click", "view"])
    out = [f.agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first")).select(F.lit(t).alias("target"), "n", "first").filter("n > 0") for t, f in parts.items()]
    return out[0].unionByName(out[1])


@query("k10_k11_replace_day", """
WITH old AS (SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY ALL), new AS (SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-07' GROUP BY ALL)
SELECT strftime(day, '%Y-%m-%d') AS day, user_id, n FROM (SELECT * FROM old WHERE day NOT IN (SELECT day FROM new) UNION ALL SELECT * FROM new)""")
def replace_day(spark, sf):
    ev = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    per = lambda f: f.groupBy("day", "user_id").agg(F.count(F.lit(1)).alias("n"))
    at = lambda d: F.lit(d + " 00:00:00").cast("timestamp_ntz")
    out = wm.replace_days(per(ev.filter("event_id % 2 = 0")), per(ev.filter((F.col("ts") >= at("2024-01-05")) & (F.col("ts") < at("2024-01-07")))), "day")
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("k13_m8_completeness", """
WITH p AS (SELECT l_orderkey AS run, l_linenumber, count(*) AS c FROM lineitem GROUP BY ALL), r AS (SELECT run, sum(c)::BIGINT AS n_rows, sum((c > 1)::INT)::BIGINT AS dup_grains FROM p GROUP BY run)
SELECT o_orderkey AS run, 4 AS expected, coalesce(n_rows, 0) AS n_rows, coalesce(dup_grains, 0) AS dup_grains, coalesce(n_rows, 0) = 4 AND coalesce(dup_grains, 0) = 0 AS complete FROM orders LEFT JOIN r ON run = o_orderkey""")
def completeness(spark, sf):
    rows = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "run")
    expected = table(spark, sf, "orders").select(F.col("o_orderkey").alias("run"), F.lit(4).alias("expected"))
    return wm.completeness(rows, "run", expected, ["l_linenumber"])


@query("k14_g27_merge_preserving", """
WITH h AS (SELECT user_id AS k, min(event_id) AS lo, max(event_id) AS hi, max(CASE WHEN event_type = 'click' THEN 'c' END) AS note, list_sort(list(DISTINCT event_type)) AS names FROM events WHERE event_id % 5 < 2 GROUP BY 1),
b AS (SELECT user_id AS k, min(event_id) AS lo, max(event_id) AS hi, max('b') AS note, list_sort(list(DISTINCT event_type)) AS names FROM events WHERE event_id % 5 >= 3 GROUP BY 1)
SELECT k, least(h.lo, b.lo) AS lo, greatest(h.hi, b.hi) AS hi, coalesce(h.note, b.note) AS note, array_to_string(list_sort(list_distinct(list_concat(coalesce(h.names, []), coalesce(b.names, [])))), ',') AS names FROM h FULL JOIN b USING (k)""")
def merge_preserving(spark, sf):
    ev = table(spark, sf, "events")
    agg = lambda f, note: f.groupBy(F.col("user_id").alias("k")).agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi"), F.max(note).alias("note"), F.array_sort(F.collect_set("event_type")).alias("names"))
    old = agg(ev.filter("event_id % 5 < 2"), F.when(F.col("event_type") == "click", "c"))
    new = agg(ev.filter("event_id % 5 >= 3"), F.lit("b"))
    out = wm.merge_preserving(old, new, ["k"], {"lo": "least", "hi": "greatest", "note": "keep", "names": "union"})
    return out.withColumn("names", F.array_join("names", ","))


@query("k15_k31_new_unless_null", """
WITH old AS (SELECT c_custkey AS k, c_mktsegment AS seg FROM customer WHERE c_custkey % 2 = 0), new AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN 'NEW' END AS seg FROM customer WHERE c_custkey % 3 = 0)
SELECT k, coalesce(new.seg, old.seg) AS seg FROM old FULL JOIN new USING (k)""")
def new_unless_null(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"))
    new = c.filter("k % 3 = 0").withColumn("seg", F.when(F.col("k") % 4 == 0, "NEW"))
    return wm.merge_preserving(c.filter("k % 2 = 0"), new, ["k"], {"seg": "new"})


@query("k16_k17_j17_update_from", """
SELECT c_custkey, CASE WHEN n_nationkey IS NOT NULL AND c_acctbal >= 0 THEN n_name ELSE c_mktsegment END AS label FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey""")
def update_from(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nk"), F.col("c_mktsegment").alias("label"), "c_acctbal")
    n = table(spark, sf, "nation").filter("n_regionkey < 3").select(F.col("n_nationkey").alias("nk"), F.col("n_name").alias("label"))
    return wm.update_from(c, n, ["nk"], ["label"], F.col("c_acctbal") < 0).select("c_custkey", "label")


@query("k32_not_found", "SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25)")
def not_found(spark, sf):
    parts = table(spark, sf, "part").filter("p_size < 25").select(F.col("p_partkey").alias("l_partkey"))
    return wm.not_found(table(spark, sf, "lineitem").select("l_partkey").distinct(), parts, ["l_partkey"])


@query("k30_fail_counts", """
WITH led AS (SELECT s_suppkey AS k, (s_suppkey % 4)::INT AS fails FROM supplier WHERE s_suppkey % 2 = 0), o AS (SELECT s_suppkey AS k, s_acctbal > 0 AS ok FROM supplier WHERE s_suppkey % 3 = 0)
SELECT k, CASE WHEN ok IS NULL THEN coalesce(fails, 0) WHEN ok THEN 0 ELSE coalesce(fails, 0) + 1 END AS fails FROM led FULL JOIN o USING (k)""")
def fail_counts(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), "s_acctbal")
    return wm.fail_counts(s.filter("k % 2 = 0").select("k", (F.col("k") % 4).cast("int").alias("fails")), s.filter("k % 3 = 0").select("k", (F.col("s_acctbal") > 0).alias("ok")), ["k"])


@query("k23_manifest_merge", """
WITH old AS (SELECT strftime(o_orderdate, '%Y-%m') AS date, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), new AS (SELECT strftime(o_orderdate, '%Y-%m') AS date, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY 1)
SELECT date, coalesce(new.n, old.n) AS n FROM old FULL JOIN new USING (date)""")
def manifest(spark, sf):
    o = table(spark, sf, "orders").withColumn("date", F.date_format("o_orderdate", "yyyy-MM"))
    per = lambda f: f.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    new = per(o.filter(F.col("o_orderdate") >= F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"))).withColumn("_seq", F.lit(0))
    return wm.upsert(per(o.filter("o_orderkey % 2 = 0")), new, ["date"]).orderBy("date")


@query("k25_k26_retention", """
WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events), a AS (SELECT day FROM d WHERE day(day) % 3 = 0)
SELECT strftime(day, '%Y-%m-%d') AS day FROM d WHERE day >= DATE '2024-01-30' - 20 AND day NOT IN (SELECT day FROM a)""")
def retention(spark, sf):
    d = table(spark, sf, "events").select(F.to_date("ts").alias("day")).distinct()
    kept = wm.retain(d, "day", F.lit("2024-01-30").cast("date"), 20)
    return wm.to_archive(kept, d.filter(F.dayofmonth("day") % 3 == 0)).select(F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("k26_archive_then_delete", """
WITH l AS (SELECT CAST(ts AS DATE) AS day, event_type FROM events), n AS (SELECT day, count(*) AS n, count_if(event_type = 'view') AS views FROM l GROUP BY 1)
SELECT strftime(day, '%Y-%m-%d') AS day, n FROM n WHERE day >= DATE '2024-01-20' OR day(day) % 6 = 0 AND views <> n""")
def archive_then_delete(spark, sf):
    """Days that the archive lacks are written to it and counted there; old days go from the table only where all their rows are in the archive.

    Every third day is archived already, every sixth in part only, and so stays.
    """
    live = table(spark, sf, "events").select(F.to_date("ts").alias("day"), "event_id", "event_type")
    path, schema = folder(spark, "archive"), "event_id long, event_type string, day date"
    before = live.filter((F.dayofmonth("day") % 3 == 0) & ((F.dayofmonth("day") % 6 > 0) | (F.col("event_type") == "view")))
    before.write.partitionBy("day").parquet(path)
    wm.not_archived(live, spark.read.schema(schema).parquet(path), "day").write.mode("append").partitionBy("day").parquet(path)
    kept = wm.without_archived(live, spark.read.schema(schema).parquet(path), "day", F.lit("2024-01-20").cast("date"))
    return kept.groupBy("day").agg(F.count(F.lit(1)).alias("n")).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n")


@query("k18_buffered", """
WITH f AS (SELECT 'b' || event_id AS name, ts AS failed_at FROM events WHERE event_type = 'error' OR event_id % 7 = 0) SELECT name FROM f WHERE failed_at >= TIMESTAMP '2024-01-30' - INTERVAL 3 DAY ORDER BY failed_at DESC, name LIMIT 500""")
def buffered(spark, sf):
    f = table(spark, sf, "events").filter((F.col("event_type") == "error") | (F.col("event_id") % 7 == 0)).select(F.concat(F.lit("b"), F.col("event_id").cast("string")).alias("name"), F.col("ts").alias("failed_at"))
    return wm.buffered(f, F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")).select("name")


@query("r9_r10_keep_last_first", "SELECT user_id, min_by(event_id, event_id) AS first, max_by(event_id, event_id) AS last FROM events GROUP BY user_id")
def last_first(spark, sf):
    ev = table(spark, sf, "events").withColumn("_seq", F.col("event_id"))
    first, last = wm.keep_first(ev, ["user_id"]), wm.keep_last(ev, ["user_id"])
    return first.select("user_id", F.col("event_id").alias("first")).join(last.select("user_id", F.col("event_id").alias("last")), "user_id")
