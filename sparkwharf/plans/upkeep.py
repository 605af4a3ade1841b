"""Queries: staged loads, side tables, frames, notices, ledgers, gates, reconciliation and diagnostics."""

from __future__ import annotations

from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from sparkwharf.functions import timeutil as tu
from sparkwharf.operators import outline
from sparkwharf.operators import write_modes as wm
from sparkwharf.plans.register import query, table
from sparkwharf.sources.shared import folder
from sparkwharf.streaming.dead_letters import DeadLetters


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _day(column: str):
    return F.date_format(column, "yyyy-MM-dd")


@query("k24_staged_refresh", """
WITH t AS (SELECT CAST(ts AS DATE) AS d, event_type, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY ALL), s AS (SELECT CAST(ts AS DATE) AS d, event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY ALL)
SELECT strftime(d, '%Y-%m-%d') AS day, event_type, n FROM t WHERE d NOT IN (SELECT d FROM s) UNION ALL SELECT strftime(d, '%Y-%m-%d'), event_type, n FROM s""")
def staged_refresh(spark, sf):
    """Rows are copied to a stage, the days they touch are refreshed from it, and the stage is emptied."""
    ev = table(spark, sf, "events").select(F.to_date("ts").alias("day"), "event_type", "ts")
    per = lambda rows: rows.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"))
    stage, refreshed = folder(spark, "stage"), folder(spark, "refreshed")
    ev.filter(F.col("ts") >= _ntz("2024-01-10 00:00:00")).select("day", "event_type").write.parquet(stage)
    staged = spark.read.parquet(stage)
    wm.replace_days(per(ev.filter("event_type <> 'error'")), per(staged), "day").write.parquet(refreshed)
    spark.createDataFrame([], staged.schema).write.mode("overwrite").parquet(stage)
    return spark.read.parquet(refreshed).withColumn("day", _day("day"))


@query("k28_reference_documents", """
WITH o AS (SELECT o_orderkey AS k, o_orderpriority AS system, strftime(o_orderdate, '%Y-%m') AS date, o_orderdate AS made FROM orders),
old AS (SELECT system, date, '{"n":' || count(*) || ',"last":"' || strftime(max(made), '%Y-%m-%d') || '"}' AS doc FROM o WHERE k % 2 = 0 GROUP BY 1, 2),
new AS (SELECT system, date, '{"n":' || count(*) || ',"last":"' || strftime(max(made), '%Y-%m-%d') || '"}' AS doc FROM o WHERE made >= TIMESTAMP '1997-01-01' GROUP BY 1, 2)
SELECT system, date, coalesce(new.doc, old.doc) AS doc FROM old FULL JOIN new USING (system, date)""")
def reference_documents(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("system"), F.date_format("o_orderdate", "yyyy-MM").alias("date"), "o_orderdate")
    doc = F.to_json(F.struct(F.count(F.lit(1)).alias("n"), _day(F.max("o_orderdate")).alias("last")))
    per = lambda rows: rows.groupBy("system", "date").agg(doc.alias("doc"))
    new = per(o.filter(F.col("o_orderdate") >= _ntz("1997-01-01 00:00:00"))).withColumn("_seq", F.lit(0))
    return wm.upsert(per(o.filter("o_orderkey % 2 = 0")), new, ["system", "date"])


@query("k29_station_side_upsert", """
WITH b AS (SELECT user_id AS k, max_by(event_type, event_id) AS kind FROM events WHERE event_type <> 'error' GROUP BY 1), t AS (SELECT c_custkey AS k, c_mktsegment AS kind FROM customer)
SELECT k, coalesce(b.kind, t.kind) AS kind FROM t FULL JOIN b USING (k)""")
def station_side_upsert(spark, sf):
    """What a batch of measurements says of its stations goes to the stations' own table; the last row of each counts, by a combining maximum."""
    said = table(spark, sf, "events").filter("event_type <> 'error'").groupBy(F.col("user_id").alias("k")).agg(F.max_by("event_type", "event_id").alias("kind"))
    known = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("kind"))
    return wm.merge_preserving(known, said, ["k"], {"kind": "new"})


@query("k27_a7_frame_store", """
WITH f AS (SELECT lang AS dataset_id, doc_id // 3 AS observed, min(doc_id) AS doc_id FROM documents GROUP BY ALL)
SELECT f.dataset_id, f.observed, octet_length(encode(d.text)) AS image_size, base64(encode(d.text)) AS image_b64 FROM f JOIN (SELECT doc_id, min(text) AS text FROM documents GROUP BY 1) d USING (doc_id)""")
def frame_store(spark, sf):
    """One frame for each key of set and time, the first to arrive; bytes meet no aggregate but the one by row id."""
    d = table(spark, sf, "documents").select("doc_id", "text", "lang")
    first = d.groupBy(F.col("lang").alias("dataset_id"), F.floor(F.col("doc_id") / 3).alias("observed")).agg(F.min("doc_id").alias("doc_id"))
    raw = d.groupBy("doc_id").agg(F.encode(F.min("text"), "UTF-8").alias("raw"))
    return first.join(raw, "doc_id").select("dataset_id", "observed", F.octet_length("raw").cast("long").alias("image_size"), F.translate(F.base64("raw"), "\r\n", "").alias("image_b64"))


def manifest(spark, sf, dataset_ids: list[str], since: str, until: str, step_minutes: int | None = None):
    """Frames of some sets in [since, until) that have a key, thinned to whole steps if asked."""
    f = table(spark, sf, "events").filter(F.col("event_type").isin(dataset_ids) & (F.col("ts") >= _ntz(since)) & (F.col("ts") < _ntz(until)) & (F.col("value") >= 100))
    f = f.filter(tu.thinned(F.col("ts"), step_minutes)) if step_minutes else f
    return f.select(F.col("event_type").alias("dataset_id"), "event_id", F.concat(F.lit("frames/"), "event_type", F.lit("/"), F.col("event_id").cast("string")).alias("image_key"))


@query("a7_frame_manifest", """
SELECT event_type AS dataset_id, event_id, 'frames/' || event_type || '/' || event_id AS image_key FROM events
WHERE event_type IN ('view', 'click') AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25' AND value >= 100 AND (CAST(epoch(ts) AS BIGINT) // 60) % 5 = 0""")
def frame_manifest(spark, sf):
    return manifest(spark, sf, ["view", "click"], "2024-01-05 00:00:00", "2024-01-25 00:00:00", 5)


@query("a7_frame_list", """
SELECT event_type AS dataset_id, event_id, 'frames/' || event_type || '/' || event_id AS image_key FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-29' AND ts < TIMESTAMP '2024-01-30' AND value >= 100""")
def frame_list(spark, sf):
    return manifest(spark, sf, ["purchase"], "2024-01-29 00:00:00", "2024-01-30 00:00:00")


@query("t12_notice_days", """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'error'), r AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS run FROM d),
f AS (SELECT user_id, day, day - min(day) OVER (PARTITION BY user_id, run) AS since FROM r)
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, CAST(since AS INTEGER) AS since, since IN (0, 1, 3, 7) AS notify FROM f""")
def notice_days(spark, sf):
    """An anomaly seen day after day is told of when new and after 1, 3 and 7 days; a day without it ends it."""
    d = table(spark, sf, "events").filter("event_type = 'error'").select("user_id", F.to_date("ts").alias("day")).distinct()
    run = F.date_sub("day", F.row_number().over(Window.partitionBy("user_id").orderBy("day")))
    first = F.min("day").over(Window.partitionBy("user_id", "run"))
    out = d.withColumn("run", run).withColumn("since", F.date_diff("day", first))
    return out.select("user_id", _day("day").alias("day"), "since", F.col("since").isin(0, 1, 3, 7).alias("notify"))


@query("t13_attempt_ledger", """
WITH g AS (SELECT o_custkey, count_if(o_orderstatus = 'F') AS done, count_if(o_orderstatus = 'O') AS failed, max(CASE WHEN o_orderstatus = 'O' THEN o_orderdate END) AS last FROM orders GROUP BY 1)
SELECT c_custkey, coalesce(failed, 0) AS failed FROM customer LEFT JOIN g ON c_custkey = o_custkey
WHERE coalesce(done, 0) = 0 AND coalesce(failed, 0) < 3 AND (last IS NULL OR last < TIMESTAMP '2001-01-01')""")
def attempt_ledger(spark, sf):
    """Work that is neither done nor given up nor tried of late: an anti-join of the work with its ledger of attempts, and how often what is left has failed."""
    work, tries = table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_orderdate")
    failed = tries.filter("o_orderstatus = 'O'").groupBy("c_custkey").agg(F.count(F.lit(1)).alias("failed"), F.max("o_orderdate").alias("last"))
    shut = tries.filter("o_orderstatus = 'F'").select("c_custkey").unionByName(failed.filter((F.col("failed") >= 3) | (F.col("last") >= _ntz("2001-01-01 00:00:00"))).select("c_custkey"))
    todo = work.join(shut, "c_custkey", "left_anti")
    return todo.join(failed, "c_custkey", "left").select("c_custkey", F.coalesce("failed", F.lit(0).cast("long")).alias("failed"))


@query("m8_gate", """
WITH g AS (SELECT l_orderkey AS run, count(*) AS n, count_if(coalesce(l_returnflag, '') = '' OR l_partkey IS NULL) AS required, count_if(l_tax IS NULL) AS metric, count(DISTINCT l_suppkey) AS counties, count(*) - count(DISTINCT l_linenumber) AS ids,
 count_if(l_quantity < 1 OR l_quantity > 49) AS months, count_if(year(l_shipdate) <= 1995) AS years, count(*) - count(DISTINCT (l_partkey % 8, l_returnflag)) AS grains FROM lineitem GROUP BY 1)
SELECT run, CASE WHEN n < 2 THEN 'rows' WHEN required > 0 THEN 'required' WHEN metric > 0 THEN 'metric' WHEN counties < 2 THEN 'counties' WHEN ids > 0 THEN 'ids' WHEN months > 0 THEN 'months' WHEN years > 0 THEN 'years' WHEN grains > 0 THEN 'grains' ELSE 'complete' END AS verdict FROM g""")
def gate(spark, sf):
    """A run may be published if it passes every check; the first one that it fails is named.

    Rows are dealt by run once, with the few columns that are asked for; what repeats is told from the row before, so no distinct count multiplies them.
    """
    bad = lambda c: F.count_if(c) > 0
    n = F.count(F.lit(1))
    checks = {
        "rows": n < 2,
        "required": bad((F.coalesce("grain.flag", F.lit("")) == "") | F.col("grain.part").isNull()),
        "metric": bad(F.col("no_tax")),
        "counties": F.coalesce(F.min("l_suppkey") == F.max("l_suppkey"), F.lit(True)),
        "ids": bad(F.col("line_again")),
        "months": bad(F.col("odd_month")),
        "years": bad(F.col("old")),
        "grains": bad(F.col("grain_again")),
    }
    grain = F.struct((F.col("l_partkey") % 8).alias("part"), F.col("l_returnflag").alias("flag")).alias("grain")
    flags = [F.col("l_tax").isNull().alias("no_tax"), (~F.col("l_quantity").between(1, 49)).alias("odd_month"), (F.year("l_shipdate") <= 1995).alias("old")]
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("run"), "l_suppkey", "l_linenumber", grain, *flags)
    run, line = Window.partitionBy("run"), F.col("l_linenumber")
    again = {"line_again": line.isNull() | (line == F.lag(line).over(run.orderBy(line))), "grain_again": F.col("grain").eqNullSafe(F.lag("grain").over(run.orderBy("grain")))}
    rows = rows.withColumns(again)
    g = rows.groupBy("run").agg(*[c.alias(name) for name, c in checks.items()])
    return g.select("run", F.coalesce(*[F.when(F.col(c), c) for c in checks], F.lit("complete")).alias("verdict"))


@query("m10_severities", """
WITH db AS (SELECT s_suppkey AS k, s_nationkey < 12 AS static, s_acctbal < 0 AS idle FROM supplier), st AS (SELECT DISTINCT l_suppkey + 3 AS k FROM lineitem WHERE l_quantity >= 49), ob AS (SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_tax >= 0.08)
SELECT db.k, CASE WHEN static AND st.k IS NULL THEN 'warn' WHEN static OR ob.k IS NOT NULL OR idle THEN 'ok' ELSE 'critical' END AS severity, CASE WHEN static AND st.k IS NOT NULL OR NOT static AND (ob.k IS NOT NULL OR idle) THEN 'present' ELSE 'missing_object' END AS code FROM db LEFT JOIN st ON st.k = db.k LEFT JOIN ob ON ob.k = db.k
UNION ALL SELECT k, 'warn', 'orphan' FROM st WHERE k NOT IN (SELECT k FROM db)
UNION ALL SELECT k, 'info', 'new_table' FROM db WHERE static AND k NOT IN (SELECT k FROM st)""")
def severities(spark, sf):
    """Tables, backup records and stored objects held against each other in both directions; one full join gives each key's findings."""
    li = table(spark, sf, "lineitem")
    db = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), (F.col("s_nationkey") < 12).alias("static"), (F.col("s_acctbal") < 0).alias("idle"), F.lit(True).alias("_db"))
    state = li.filter("l_quantity >= 49").select((F.col("l_suppkey") + 3).alias("k")).distinct().withColumn("_state", F.lit(True))
    stored = li.filter("l_tax >= 0.08").select(F.col("l_suppkey").alias("k")).distinct().withColumn("_stored", F.lit(True))
    j = db.join(state, "k", "full").join(stored, "k", "left")
    has = lambda c: F.coalesce(F.col(c), F.lit(False))
    said = lambda severity, code: F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"))
    found = (
        F.when(~has("_db"), F.array(said("warn", "orphan")))
        .when(has("static") & ~has("_state"), F.array(said("warn", "missing_object"), said("info", "new_table")))
        .when(has("static") | has("_stored") | has("idle"), F.array(said("ok", "present")))
        .otherwise(F.array(said("critical", "missing_object")))
    )
    return j.select("k", F.inline(found))


def refresh(spark, sf, day: str) -> int:
    """Write the day's totals anew; how many rows that made, counted while they are written."""
    seen, start = Observation(), _ntz(f"{day} 00:00:00")
    rows = table(spark, sf, "events").filter((F.col("ts") >= start) & (F.col("ts") < start + F.expr("INTERVAL 1 DAY")))
    totals = rows.groupBy("user_id").agg(F.sum("value").alias("total"), F.lit(day).alias("day"))
    totals.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(folder(spark, f"totals-{day}"))
    return seen.get["n"]


@query("d2_refresh_counts", "SELECT strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT user_id) AS inserted FROM events WHERE ts >= TIMESTAMP '2024-01-19' AND ts < TIMESTAMP '2024-01-21' GROUP BY 1")
def refresh_counts(spark, sf):
    """Yesterday and today, as late rows ask for; the days are a parameter of the job, not a cut of its rows."""
    return spark.createDataFrame([(d, refresh(spark, sf, d)) for d in ("2024-01-19", "2024-01-20")], "day string, inserted long")


@query("s22_catalog_scan", """
SELECT table_name AS name, min(CASE WHEN column_name IN ('ts', 'o_orderdate', 'l_shipdate') THEN column_name END) AS time_column FROM information_schema.columns WHERE table_name IN ('customer', 'events', 'lineitem', 'orders', 'part', 'supplier') GROUP BY 1""")
def catalog_scan(spark, sf):
    """Tables of the catalog but children of partitioned ones, and the time column each has."""
    names = ("customer", "events", "lineitem", "orders", "part", "supplier")
    views = [f"scan_{n}" for n in names] + ["scan_events_p2024_01"]
    for view in views:
        table(spark, sf, "events" if view.endswith("_p2024_01") else view.removeprefix("scan_")).createOrReplaceTempView(view)
    found = sorted(t.name for t in spark.catalog.listTables() if t.name in views)
    rows = []
    for name in found:
        columns = [c.name for c in spark.catalog.listColumns(name)]
        rows.append((name.removeprefix("scan_"), next((c for c in ("ts", "o_orderdate", "l_shipdate") if c in columns), None)))
    for view in views:
        spark.catalog.dropTempView(view)
    return spark.createDataFrame(rows, "name string, time_column string").filter(~F.col("name").rlike(r"_p\d{4}_\d{2}$"))


@query("t17_k18_replayed", "SELECT o_orderkey, year(o_orderdate) AS year FROM orders WHERE year(o_orderdate) <> 1996")
def replayed(spark, sf):
    """Orders come as a batch a year; the sink refuses every other one, which is queued and replayed later. One year is too old by then."""
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    path, refused = folder(spark, "replayed"), {1996, 1998, 2000}

    def write(batch, year):
        if year in refused:
            raise ConnectionError("the table is locked")
        batch.write.mode("overwrite").parquet(f"{path}/batch={year}")

    letters, clock = DeadLetters(spark, folder(spark, "dead-letters"), days=3 * 366), {}
    body = letters.guarded("orders", write, lambda: clock["year"] * 366 * 86400.0)
    for r in o.select("year").distinct().orderBy("year").collect():  # a row a year
        clock["year"] = r["year"]
        body(o.filter(F.col("year") == r["year"]), r["year"])
    refused.clear()
    letters.replay({"orders": write}, 2000 * 366 * 86400.0)
    return spark.read.schema("o_orderkey long, year int").parquet(path).drop("batch")


@query("f41_recent_window", "SELECT event_id, ts >= TIMESTAMP '2024-01-30' - to_hours(CAST(event_id % 480 AS INTEGER)) AS recent FROM events")
def recent_window(spark, sf):
    window = F.make_dt_interval(F.lit(0), (F.col("event_id") % 480).cast("int"))
    return table(spark, sf, "events").select("event_id", (F.col("ts") >= _ntz("2024-01-30 00:00:00") - window).alias("recent"))


@query("a10_sessions", "SELECT user_id AS app, event_type AS state, count(*) AS n FROM events GROUP BY ALL ORDER BY n DESC, app, state LIMIT 30")
def sessions(spark, sf):
    """Connections by application and state, the thirty most."""
    return table(spark, sf, "events").groupBy(F.col("user_id").alias("app"), F.col("event_type").alias("state")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "app", "state").limit(30)


@query("a10_longest_open", "SELECT o_orderkey, CAST(DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS INTEGER) AS days, left(o_orderpriority, 8) AS preview FROM orders WHERE o_orderstatus <> 'F' ORDER BY o_orderdate, o_orderkey LIMIT 20")
def longest_open(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderstatus <> 'F'").orderBy("o_orderdate", "o_orderkey").limit(20)
    return o.select("o_orderkey", F.date_diff(F.lit("2002-01-01").cast("date"), F.col("o_orderdate").cast("date")).alias("days"), F.left("o_orderpriority", F.lit(8)).alias("preview"))


@query("a10_stuck_refreshes", "SELECT p_partkey, p_size, left(p_name, 10) AS preview FROM part WHERE (p_name ILIKE '%COLD_w%' OR p_name ILIKE '%small%') AND p_type <> 'ECONOMY'")
def stuck_refreshes(spark, sf):
    named = F.col("p_name").ilike("%COLD_w%") | F.col("p_name").ilike("%small%")
    return table(spark, sf, "part").filter(named & (F.col("p_type") != "ECONOMY")).select("p_partkey", "p_size", F.left("p_name", F.lit(10)).alias("preview"))


@query("a10_last_runs", """
SELECT event_type AS job, event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS start_local, left(props, 80) AS message FROM events ORDER BY ts DESC, event_id DESC LIMIT 30""")
def last_runs(spark, sf):
    newest = table(spark, sf, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(30)
    return newest.select(F.col("event_type").alias("job"), "event_id", F.date_format(tu.local_time(F.col("ts")), "yyyy-MM-dd HH:mm:ss").alias("start_local"), F.left("props", F.lit(80)).alias("message"))


@query("a10_slow_jobs", """
SELECT o_orderpriority AS job, count(*) AS runs, round(avg(date_diff('day', o_orderdate, l_shipdate)), 6) AS avg_days, max(date_diff('day', o_orderdate, l_shipdate)) AS max_days, CAST(count_if(l_returnflag = 'R') AS BIGINT) AS failed
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND l_shipdate IS NOT NULL GROUP BY 1""")
def slow_jobs(spark, sf):
    o = table(spark, sf, "orders").filter(F.col("o_orderdate") >= _ntz("1997-01-01 00:00:00")).select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_orderdate")
    days = F.date_diff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")).cast("long")
    j = table(spark, sf, "lineitem").filter("l_shipdate IS NOT NULL").join(o, "l_orderkey")
    return j.groupBy(F.col("o_orderpriority").alias("job")).agg(F.count(F.lit(1)).alias("runs"), F.round(F.avg(days), 6).alias("avg_days"), F.max(days).alias("max_days"), F.count_if(F.col("l_returnflag") == "R").alias("failed"))


@query("x7_type_outlines")
def type_outlines(spark, sf):
    """The union of boxes of ``g9_x7_area_union`` as an outline for each kind."""
    x, y = F.col("event_id") % 40, F.col("event_id") % 30
    boxes = F.array(*[F.struct((x + i).alias("x"), (y + j).alias("y")) for i in (0, 1) for j in (0, 1)])
    return outline.cell_union(table(spark, sf, "events").select("event_type", F.explode(boxes).alias("c")).select("event_type", "c.x", "c.y"), "event_type")
