"""Queries: formats, geometry, classifiers and batch forms of stateful rules that feeds need."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkwharf.functions import geo
from sparkwharf.functions import text as tx
from sparkwharf.functions import timeutil as tu
from sparkwharf.plans.register import query, table

AS_OF = datetime(2024, 1, 20, 17)


@query("f15_road_marks", """
WITH r AS (SELECT o_orderkey AS k, ['國道', '省道台', '快速公路'][o_orderkey % 3 + 1] AS class, o_orderkey % 11 AS n, ['北', '南向', ' 東', '雙向', 'nb', NULL][o_orderkey % 6 + 1] AS dir, o_orderkey % 5 AS form FROM orders)
SELECT k AS o_orderkey, CASE WHEN n = 0 THEN '' ELSE class || n || CASE WHEN n = 10 THEN '甲' ELSE '' END END AS road, CASE trim(dir) WHEN '北' THEN 'N' WHEN '南向' THEN 'S' WHEN '東' THEN 'E' WHEN '雙向' THEN 'B' WHEN 'nb' THEN 'NB' ELSE '' END AS direction,
 CASE form WHEN 0 THEN k % 400 * 1000 + k % 1000 WHEN 1 THEN k % 400 * 1000 + k % 1000 END::BIGINT AS metres FROM r""")
def road_marks(spark, sf):
    """Names keep the road's class, so roads of one number stay apart; marks of another form have no kilometre."""
    k, km, m = F.col("o_orderkey"), (F.col("o_orderkey") % 400).cast("string"), F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0")
    mark = F.when(k % 5 == 0, F.concat(km, F.lit("K+"), m)).when(k % 5 == 1, F.concat(F.lit(" "), km, F.lit("+"), m, F.lit("附近"))).when(k % 5 == 2, F.concat(km, F.lit(".5K"))).when(k % 5 == 3, km)
    kind = F.element_at(F.array(*map(F.lit, ("國道", "省道台", "快速公路"))), (k % 3 + 1).cast("int"))
    n = k % 11
    numeral = F.when(n == 10, "十").otherwise(F.substr(F.lit("一二三四五六七八九"), n.cast("int"), F.lit(1)))
    road = F.when(n > 0, F.concat(kind, numeral, F.when(n % 2 == 0, "號").otherwise("線"), F.when(n == 10, "甲").otherwise("")))
    way = F.element_at(F.array(*map(F.lit, ("北", "南向", " 東", "雙向", "nb", None))), (k % 6 + 1).cast("int"))
    return table(spark, sf, "orders").select(k, tx.road_name(road).alias("road"), tx.road_direction(way).alias("direction"), F.round(tx.kilometre(mark) * 1000).cast("long").alias("metres"))


@query("f21_redirects", r"SELECT page_id, CASE WHEN regexp_matches(url, '^https?://') THEN url END AS target FROM pages")
def redirects(spark, sf):
    """A round trip: addresses wrapped as base64 tokens of redirect links, and unwrapped."""
    raw = F.encode("url", "UTF-8")
    n, two = F.octet_length(raw), lambda x: F.lpad(F.hex(x), 2, "0")
    size = F.when(n < 128, two(n)).otherwise(F.concat(two(n % 128 + 128), two(F.floor(n / 128))))
    token = tx.encoded_base64(F.unhex(F.concat(F.lit("081322"), size, F.hex(raw), F.lit("D20100"))))
    link = F.concat(F.lit("https://n.example/rss/articles/"), F.rtrim(F.translate(token, "+/", "-_"), F.lit("=")))
    return table(spark, sf, "pages").select("page_id", tx.redirect_target(link).alias("target"))


@query("f24_titles", r"""
SELECT p_partkey, '快訊臺北' || lower(regexp_replace(p_name, '[^\p{L}\p{N}]', '', 'g')) || CASE p_partkey % 4 WHEN 3 THEN 'dailynews' ELSE '' END AS title FROM part""")
def titles(spark, sf):
    """Words in brackets stay; the outlet goes behind any of its signs, but not without a blank before one."""
    k = F.col("p_partkey")
    outlet = F.element_at(F.array(*map(F.lit, (" - Daily News", " — Daily News", " ｜Daily News", "-Daily News"))), (k % 4 + 1).cast("int"))
    return table(spark, sf, "part").select(k, tx.clean_title(F.concat(F.lit(" 【快訊】台北 "), "p_name", outlet)).alias("title"))


@query("f39_orbits", """
WITH m AS (SELECT o_orderkey, 0.5::DOUBLE + (o_orderkey % 160) / 10.0::DOUBLE AS m FROM orders), a AS (SELECT o_orderkey, pow(398600.4418 * pow(86400.0 / (m * 2 * pi()), 2), 1 / 3.0::DOUBLE) - 6371.0 AS a FROM m)
SELECT o_orderkey, CASE WHEN a < 2000 THEN 'LEO' WHEN a < 35000 THEN 'MEO' WHEN a < 36600 THEN 'GEO' ELSE 'HEO' END AS orbit FROM a""")
def orbits(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", geo.orbit_class(F.lit(0.5) + (F.col("o_orderkey") % 160) / F.lit(10.0)).alias("orbit"))


@query("f43_reports", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN (o_orderkey % 50)::INT END AS ships FROM orders")
def reports(spark, sf):
    k = F.col("o_orderkey")
    text = F.when(k % 3 > 0, F.concat(F.lit("Observed "), (k % 50).cast("string"), F.lit(" ships near the strait"))).otherwise("Observed none")
    return table(spark, sf, "orders").select(k, tx.report_count(text, r"(\d+) ships").alias("ships"))


@query("f46_bulletin_times", """
WITH t AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, '-' || lpad(CAST(o_orderkey % 31 + 1 AS VARCHAR), 2, '0') || ' ' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':30' AS s FROM orders),
u AS (SELECT k, d, try_strptime(strftime(d, '%Y-%m') || s, '%Y-%m-%d %H:%M') AS this, try_strptime(strftime(d - INTERVAL 1 MONTH, '%Y-%m') || s, '%Y-%m-%d %H:%M') AS last FROM t)
SELECT k AS o_orderkey, strftime(CASE WHEN this IS NULL OR this > d + INTERVAL 20 DAY THEN last ELSE this END, '%Y-%m-%d %H:%M') AS at FROM u""")
def bulletin_times(spark, sf):
    k = F.col("o_orderkey")
    group = F.format_string("%02d%02d30Z", k % 31 + 1, k % 24)
    return table(spark, sf, "orders").select(k, F.date_format(tu.day_hour_minute(group, F.to_date("o_orderdate")), "yyyy-MM-dd HH:mm").alias("at"))


@query("f47_year_months", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL WHEN o_orderkey % 5 = 2 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') END AS day FROM orders")
def year_months(spark, sf):
    """A round trip of Minguo years of three or four digits with a month, and of whole dates; the thirteenth month is none."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    year, month = F.year(d) - tu.ROC_EPOCH, F.month(d)
    s = F.when(k % 5 == 0, F.format_string("%03d%02d", year, month)).when(k % 5 == 1, F.format_string(" %04d%02d", year, month)).when(k % 5 == 2, F.format_string("%03d%02d%02d", year, month, F.dayofmonth(d)))
    s = s.when(k % 5 == 3, F.format_string("%03d%02d ", year, month)).otherwise(F.format_string("%03d13", year))
    return table(spark, sf, "orders").select(k, F.date_format(tu.roc_year_month(s), "yyyy-MM-dd").alias("day"))


@query("x3_x4_x9_alert_areas", """
SELECT o_orderkey, 33 AS n, (o_orderkey % 51 + 0.5 BETWEEN o_orderkey % 50 AND o_orderkey % 50 + 2) AND (o_orderkey % 61 + 0.5 BETWEEN o_orderkey % 60 AND o_orderkey % 60 + 2) AS inside FROM orders""")
def alert_areas(spark, sf):
    k = F.col("o_orderkey")
    lat, lng = k % 50, k % 60
    circle = geo.cap_circle(F.format_string("%d.0,%d.0 5", lat, lng))
    box = geo.cap_polygon(F.format_string("%d,%d %d,%d %d,%d %d,%d", lat, lng, lat, lng + 2, lat + 2, lng + 2, lat + 2, lng))
    return table(spark, sf, "orders").select(k, F.size(circle).alias("n"), geo.in_ring(k % 61 + F.lit(0.5), k % 51 + F.lit(0.5), box).alias("inside"))


@query("x10_geojson_lines", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN 2 END AS n, CASE WHEN o_orderkey % 4 > 0 THEN (o_orderkey % 180)::DOUBLE END AS lng FROM orders""")
def geojson_lines(spark, sf):
    k = F.col("o_orderkey")
    text = F.format_string('{"type":"%s","coordinates":[[%d.0,%d.0],[0.5,1.5]]}', F.when(k % 4 > 0, "LineString").otherwise("MultiPoint"), k % 180, k % 90)
    points = geo.geojson_points(text)
    return table(spark, sf, "orders").select(k, F.when(points.isNotNull(), F.size(points)).alias("n"), F.get(points, F.lit(0))["lng"].alias("lng"))


@query("x13_ground_track", """
WITH p AS (SELECT o_orderkey, 7000.0::DOUBLE + o_orderkey % 13 AS r, radians((o_orderkey % 160 - 80)::DOUBLE) AS la, radians((o_orderkey % 350)::DOUBLE + 0.25) AS lo, 2460000.5::DOUBLE + (o_orderkey % 100) / 8.0::DOUBLE AS jd FROM orders),
c AS (SELECT *, r * cos(la) * cos(lo) AS x, r * cos(la) * sin(lo) AS y, r * sin(la) AS z, ((280.46061837::DOUBLE + 360.98564736629::DOUBLE * (jd - 2451545.0)) % 360.0) AS g FROM p),
w AS (SELECT *, degrees(atan2(y, x)) - g + 180 + 720 AS q FROM c)
SELECT o_orderkey, round(degrees(asin(z / sqrt(x * x + y * y + z * z))), 4) AS lat, round(q % 360.0 - 180, 4) AS lng, round(sqrt(x * x + y * y + z * z) - 6371.0, 4) AS alt_km FROM w""")
def ground_track(spark, sf):
    """Inertial positions, as an orbit propagator gives them, over ground."""
    k = F.col("o_orderkey")
    r, la, lo = F.lit(7000.0) + k % 13, F.radians((k % 160 - 80).cast("double")), F.radians((k % 350).cast("double") + 0.25)
    at = geo.inertial_to_geodetic(r * F.cos(la) * F.cos(lo), r * F.cos(la) * F.sin(lo), r * F.sin(la), F.lit(2460000.5) + (k % 100) / F.lit(8.0))
    return table(spark, sf, "orders").select(k, *[F.round(at[n], 4).alias(n) for n in ("lat", "lng", "alt_km")])


@query("g9_x7_area_union", """
WITH b AS (SELECT event_type, event_id % 40 AS x, event_id % 30 AS y FROM events), c AS (SELECT DISTINCT event_type, x + i AS cx, y + j AS cy FROM b, range(2) t(i), range(2) u(j))
SELECT event_type, count(*) AS cells, min(cx) AS west, max(cx) AS east, min(cy) AS south, max(cy) AS north FROM c GROUP BY 1""")
def area_union(spark, sf):
    """The union of boxes on a cell grid: cells are made distinct before they are merged, so none counts twice."""
    x, y = F.col("event_id") % 40, F.col("event_id") % 30
    cells = F.array(*[F.struct((x + i).alias("cx"), (y + j).alias("cy")) for i in (0, 1) for j in (0, 1)])
    once = table(spark, sf, "events").select("event_type", F.explode(cells).alias("c")).select("event_type", "c.*").distinct()
    return once.groupBy("event_type").agg(F.count(F.lit(1)).alias("cells"), F.min("cx").alias("west"), F.max("cx").alias("east"), F.min("cy").alias("south"), F.max("cy").alias("north"))


@query("o7_ordinals", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1 ORDER BY 2 DESC, 1")
def ordinals(spark, sf):
    return spark.sql("SELECT o_orderstatus, count(*) AS n FROM {orders} GROUP BY 1 ORDER BY 2 DESC, 1", orders=table(spark, sf, "orders"))


def listing(spark, sf, event_type: str | None = None, step_minutes: int | None = None):
    """Events, narrowed only by the parameters that are given."""
    rows = table(spark, sf, "events")
    if event_type is not None:
        rows = rows.filter(F.col("event_type") == event_type)
    return rows.filter(tu.thinned(F.col("ts"), step_minutes)) if step_minutes else rows


@query("p23_d1_optional", """
SELECT 'all' AS call, count(*) AS n FROM events UNION ALL SELECT 'type', count(*) FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 'both', count(*) FROM events WHERE event_type = 'purchase' AND ((epoch_us(ts) + 500000) // 1000000 // 60) % 10 = 0""")
def optional(spark, sf):
    calls = {"all": (), "type": ("purchase",), "both": ("purchase", 10)}
    counts = [listing(spark, sf, *args).agg(F.lit(name).alias("call"), F.count(F.lit(1)).alias("n")) for name, args in calls.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("p29_deep_flatten", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus ELSE 'unknown' END AS status, CASE WHEN o_orderkey % 6 IN (1, 2) THEN o_custkey ELSE 0 END AS customer FROM orders""")
def deep_flatten(spark, sf):
    """Records with missing objects at two depths."""
    k = F.col("o_orderkey")
    inner = F.when(k % 6 < 3, F.struct(F.col("o_custkey").alias("id")))
    text = F.to_json(F.struct(F.when(k % 3 > 0, F.struct(F.col("o_orderstatus").alias("name"), inner.alias("pad"))).alias("status")))
    got = F.from_json(text, "status struct<name:string,pad:struct<id:bigint>>")
    return table(spark, sf, "orders").select(k, F.coalesce(got["status"]["name"], F.lit("unknown")).alias("status"), F.coalesce(got["status"]["pad"]["id"], F.lit(0).cast("long")).alias("customer"))


@query("w10_direction_counts", """
WITH l AS (SELECT user_id, CAST(round(value * 100) AS BIGINT) AS v, lag(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
SELECT user_id, count(*) FILTER (v > p) AS forward, count(*) FILTER (v < p) AS backward FROM l GROUP BY 1""")
def direction_counts(spark, sf):
    e = table(spark, sf, "events").withColumn("v", F.round(F.col("value") * 100).cast("long"))
    e = e.withColumn("p", F.lag("v").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    return e.groupBy("user_id").agg(F.count_if(F.col("v") > F.col("p")).alias("forward"), F.count_if(F.col("v") < F.col("p")).alias("backward"))


@query("j8_d4_classifier", """
SELECT p_partkey, CASE WHEN p_type LIKE '%BRASS' THEN 'metal' WHEN p_size >= 25 THEN 'large' ELSE 'other' END AS kind, CASE WHEN p_type LIKE '%BRASS' THEN 'type' WHEN p_size >= 25 THEN 'size' END AS reason FROM part""")
def classifier(spark, sf):
    """A lateral call of a classifier that returns a record: one struct expression, opened."""
    record = lambda kind, reason: F.struct(F.lit(kind).alias("kind"), F.lit(reason).cast("string").alias("reason"))
    found = F.when(F.col("p_type").endswith("BRASS"), record("metal", "type")).when(F.col("p_size") >= 25, record("large", "size")).otherwise(record("other", None))
    return table(spark, sf, "part").select("p_partkey", found.alias("c")).select("p_partkey", "c.*")


@query("t3_late_days", """
SELECT strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-19 16:00:00' AND ts < TIMESTAMP '2024-01-21 16:00:00' GROUP BY 1""")
def late_days(spark, sf):
    """What a refresh rebuilds: today and yesterday, in civil time."""
    ts, days = F.col("ts"), tu.refresh_days(AS_OF)
    due = tu.in_local_day(ts, days[0]) | tu.in_local_day(ts, days[1])
    return table(spark, sf, "events").filter(due).groupBy(F.date_format(tu.local_time(ts), "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("t6_t8_seen_before", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def seen_before(spark, sf):
    """Of rows that later snapshots repeat, the first stays; a combining minimum, no window."""
    return table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))


@query("t8_sliding_snapshots", """
WITH s AS (SELECT event_id, user_id, event_type, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour FROM events)
SELECT hour AS snapshot, count(*) AS added FROM s GROUP BY 1""")
def sliding_snapshots(spark, sf):
    """Each hour's snapshot shows the last three hours, so most of it was seen before; what is new goes to the table, once."""
    hour = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000)
    shown = table(spark, sf, "events").select("event_id", F.explode(F.sequence(hour, hour + 2)).alias("snapshot"))
    # the first snapshot of each row, by a combining minimum: the same as an anti-join of every snapshot with all before it
    first = shown.groupBy("event_id").agg(F.min("snapshot").alias("snapshot"))
    return first.groupBy("snapshot").agg(F.count(F.lit(1)).alias("added"))


@query("t13_t19_backoff", """
WITH e AS (SELECT *, CAST(event_type = 'purchase' AS INT) AS ok FROM events), g AS (SELECT *, sum(ok) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM e),
f AS (SELECT *, sum(1 - ok) OVER (PARTITION BY user_id, run ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS fails FROM g)
SELECT event_id, fails::INT AS fails, CASE WHEN fails = 0 THEN 0 ELSE least(60 * CAST(pow(2, least(fails, 20) - 1) AS BIGINT), 3600) END AS wait_s FROM f""")
def backoff(spark, sf):
    """Failures in a row double the wait up to an hour; a success resets it."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    ok = (F.col("event_type") == "purchase").cast("int")
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", ok.alias("ok")).withColumn("run", F.sum("ok").over(order))
    row = Window.partitionBy("user_id", "run").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("fails", F.sum(1 - F.col("ok")).over(row).cast("int"))
    wait = F.when(F.col("fails") == 0, 0).otherwise(F.least(F.lit(60) * F.pow(F.lit(2), F.least(F.col("fails"), F.lit(20)) - 1), F.lit(3600.0)))
    return e.select("event_id", "fails", wait.cast("long").alias("wait_s"))


@query("t15_changed_only", """
WITH l AS (SELECT event_id, md5(event_type || '|' || CAST(round(value) AS BIGINT)) AS h, lag(md5(event_type || '|' || CAST(round(value) AS BIGINT))) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
SELECT event_id FROM l WHERE h IS DISTINCT FROM p""")
def changed_only(spark, sf):
    """Rows whose content hash equals the one before are passed over."""
    e = table(spark, sf, "events").withColumn("h", tx.row_key(F.col("event_type"), F.round("value").cast("long")))
    before = F.lag("h").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.withColumn("p", before).filter(~F.col("h").eqNullSafe(F.col("p"))).select("event_id")


@query("t16_cursor", """
WITH c AS (SELECT event_type, max(event_id) AS done FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1)
SELECT e.event_id FROM events e LEFT JOIN c USING (event_type) WHERE c.done IS NULL OR e.event_id > c.done""")
def cursor(spark, sf):
    """What lies beyond each feed's cursor, all of it for a feed without one."""
    e = table(spark, sf, "events").select("event_id", "event_type", "ts")
    done = e.filter(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")).groupBy("event_type").agg(F.max("event_id").alias("done"))
    return e.join(done, "event_type", "left").filter(F.col("done").isNull() | (F.col("event_id") > F.col("done"))).select("event_id")


@query("a10_diagnostics", """
SELECT 'orders' AS name, count(*) AS n, count(*) - count(o_orderdate) AS nulls, strftime(max(o_orderdate), '%Y-%m-%d') AS newest FROM orders
UNION ALL SELECT 'lineitem', count(*), count(*) - count(l_shipdate), strftime(max(l_shipdate), '%Y-%m-%d') FROM lineitem
UNION ALL SELECT 'events', count(*), count(*) - count(ts), strftime(max(ts), '%Y-%m-%d') FROM events""")
def diagnostics(spark, sf):
    """Rows, missing times and newest time of each table; one narrow aggregate a table."""
    parts = [
        table(spark, sf, name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) - F.count(at)).alias("nulls"), F.date_format(F.max(at), "yyyy-MM-dd").alias("newest"))
        for name, at in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
