"""Queries: scalar, text, time and geometry functions over whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkwharf.functions import geo
from sparkwharf.functions import text as tx
from sparkwharf.functions import timeutil as tu
from sparkwharf.operators import dedup
from sparkwharf.plans.register import query, table


@query("f1_f25_row_keys", "SELECT o_orderkey, md5(o_custkey || '|' || o_orderstatus || '|' || CAST(round(o_totalprice * 100) AS BIGINT)) AS key, ('0x' || left(md5(o_orderpriority), 15))::BIGINT AS id FROM orders")
def row_keys(spark, sf):
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return table(spark, sf, "orders").select("o_orderkey", tx.row_key(F.col("o_custkey"), F.col("o_orderstatus"), cents).alias("key"), tx.hash_id(F.col("o_orderpriority")).alias("id"))


@query("f2_f4_f5_f11_times", """
SELECT event_id, (epoch_us(ts) + 500000) // 1000000 AS epoch, strftime(date_trunc('hour', ts) + INTERVAL 10 MINUTE * (minute(ts) // 10), '%Y-%m-%dT%H:%M') AS ten, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M') AS local FROM events""")
def times(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select("event_id", tu.epoch_seconds(ts).alias("epoch"), tu.time_key(tu.floor_minutes(ts, 10)).alias("ten"), tu.time_key(tu.local_time(ts)).alias("local"))


@query("f6_f7_parse_times", """
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d %H:%M') WHEN 2 THEN strftime(o_orderdate, '%Y%m%d') ELSE 'n/a' END AS s FROM orders)
SELECT o_orderkey, strftime(coalesce(try_strptime(s, '%Y-%m-%d %H:%M:%S'), try_strptime(s, '%Y/%m/%d %H:%M'), try_strptime(s, '%Y%m%d')), '%Y-%m-%d %H:%M') AS at FROM t""")
def parse_times(spark, sf):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    s = F.when(k % 4 == 0, F.date_format(d, "yyyy-MM-dd HH:mm:ss")).when(k % 4 == 1, F.date_format(d, "yyyy/MM/dd HH:mm")).when(k % 4 == 2, F.date_format(d, "yyyyMMdd")).otherwise("n/a")
    return table(spark, sf, "orders").select(k, F.date_format(tu.first_parsed(s, ["yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm", "yyyyMMdd"]), "yyyy-MM-dd HH:mm").alias("at"))


@query("f8_r12_roc_dates", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def roc_dates(spark, sf):
    """A round trip: written in the Minguo calendar in three ways, parsed back."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    y = F.year(d) - tu.ROC_EPOCH
    s = F.when(k % 3 == 0, F.format_string("%d.%02d.%02d", y, F.month(d), F.dayofmonth(d))).when(k % 3 == 1, F.format_string("%03d%02d%02d", y, F.month(d), F.dayofmonth(d))).otherwise(F.format_string("%d/%d/%d", y, F.month(d), F.dayofmonth(d)))
    return table(spark, sf, "orders").select(k, F.date_format(tu.roc_date(s), "yyyy-MM-dd").alias("day"))


@query("f9_f10_f40_periods", """
WITH p AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders), q AS (SELECT *, make_date(year(d), (o_orderkey % 12 + 1)::INT, (o_orderkey % 28 + 1)::INT) AS e FROM p)
SELECT o_orderkey, strftime(CASE WHEN e < d THEN e + INTERVAL 1 YEAR ELSE e END, '%Y-%m-%d') AS until, (o_orderkey % 24) * 3600 + (o_orderkey % 60) * 60 + CASE WHEN (o_orderkey % 24) * 3600 + (o_orderkey % 60) * 60 < 14400 THEN 86400 ELSE 0 END AS clock FROM q""")
def periods(spark, sf):
    k = F.col("o_orderkey")
    until = tu.period_end(F.to_date("o_orderdate"), (k % 12 + 1).cast("int"), (k % 28 + 1).cast("int"))
    clock = tu.clock_seconds(F.format_string("%02d:%02d", k % 24, k % 60), F.lit(14400))
    return table(spark, sf, "orders").select(k, F.date_format(until, "yyyy-MM-dd").alias("until"), clock.cast("long").alias("clock"))


@query("f40_f41_cycles", "SELECT event_id, strftime(time_bucket(INTERVAL 6 HOUR, ts - INTERVAL 4 HOUR, TIMESTAMP '2000-01-01'), '%Y-%m-%d %H') AS cycle FROM events")
def cycles(spark, sf):
    return table(spark, sf, "events").select("event_id", F.date_format(tu.model_cycle(F.col("ts")), "yyyy-MM-dd HH").alias("cycle"))


@query("f12_f14_f28_names", """
SELECT p_partkey, upper(left(trim(p_name), 6)) AS head, lower(regexp_replace(p_type, '\\s', '', 'g')) AS key, regexp_replace(regexp_replace(p_brand, '#', '', 'g'), '[0-9]+$', '', 'g') AS brand FROM part""".replace("\\\\", "\\"))
def names(spark, sf):
    brand = F.regexp_replace(F.regexp_replace("p_brand", "#", ""), "[0-9]+$", "")
    return table(spark, sf, "part").select("p_partkey", F.upper(F.left(F.trim("p_name"), F.lit(6))).alias("head"), tx.entity_key(F.col("p_type")).alias("key"), brand.alias("brand"))


@query("f16_f17_r6_numbers", """
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '-' WHEN 1 THEN '1,' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') WHEN 2 THEN (o_orderkey % 100) || '%' WHEN 3 THEN (o_orderkey % 100) || '.5' ELSE 'abc' END AS s FROM orders)
SELECT o_orderkey, TRY_CAST(regexp_replace(nullif(s, '-'), '[,%]', '', 'g') AS DOUBLE) AS n, TRY_CAST(CASE WHEN contains(s, '.') THEN NULL ELSE regexp_replace(nullif(s, '-'), '[,%]', '', 'g') END AS BIGINT) AS i FROM t""")
def numbers(spark, sf):
    k = F.col("o_orderkey")
    n = lambda m: (k % m).cast("string")
    s = F.when(k % 5 == 0, "-").when(k % 5 == 1, F.concat(F.lit("1,"), F.lpad(n(1000), 3, "0"))).when(k % 5 == 2, F.concat(n(100), F.lit("%"))).when(k % 5 == 3, F.concat(n(100), F.lit(".5"))).otherwise("abc")
    return table(spark, sf, "orders").select(k, tx.number(s).alias("n"), tx.metric(s)["i"].alias("i"))


@query("f18_f32_f33_arithmetic", """
SELECT l_orderkey, l_linenumber, l_partkey, round(CAST(l_quantity AS DECIMAL(18,4)) * 0.3048, 2)::DOUBLE AS metres, CAST(l_quantity AS BIGINT) * 10 AS mw, greatest(l_partkey, l_suppkey) AS hi, least(l_partkey, l_suppkey) AS lo, nullif(l_linenumber, 1) AS line FROM lineitem""")
def arithmetic(spark, sf):
    q = F.col("l_quantity").cast("decimal(18,4)")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(q * F.lit("0.3048").cast("decimal(6,4)"), 2).cast("double").alias("metres"), (F.col("l_quantity").cast("long") * 10).alias("mw"), F.greatest("l_partkey", "l_suppkey").alias("hi"), F.least("l_partkey", "l_suppkey").alias("lo"), F.nullif(F.col("l_linenumber"), F.lit(1)).alias("line"))


@query("f19_strip_html", r"""
SELECT page_id, length(trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '<(?:script|style)[^>]*>.*?</(?:script|style)>', ' ', 'gis'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))) AS n FROM pages""")
def strip_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.length(tx.strip_html(F.col("html"))).cast("long").alias("n"))


@query("f20_urls", r"""
WITH u AS (SELECT page_id, regexp_replace(trim(regexp_replace(url, '[?#].*$', '') || '?utm_source=x&a=1&fbclid=2#top'), '#.*$', '') AS u FROM pages)
SELECT page_id, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://' || lower(regexp_extract(u, '://([^/?]*)', 1)) || regexp_replace(regexp_extract(u, '://[^/?]*([^?]*)', 1), '/+$', '') || '?a=1' AS url FROM u""")
def urls(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.normal_url(F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit("?utm_source=x&a=1&fbclid=2#top"))).alias("url"))


@query("f23_hamming", "SELECT * FROM (SELECT s_suppkey AS a, lead(s_suppkey) OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS b, bit_count(xor(s_suppkey * 2654435761, b * 2654435761))::INT AS d FROM supplier) WHERE b IS NOT NULL")
def hamming(spark, sf):
    """Between each supplier and the next one of its nation."""
    b = F.lead("s_suppkey").over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("a"), b.alias("b")).filter("b IS NOT NULL")
    return s.select("a", "b", tx.hamming(F.col("a") * 2654435761, F.col("b") * 2654435761).alias("d"))


@query("f27_canonical_hash", """SELECT c_custkey, sha256('{"a":' || coalesce('"' || CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END || '"', 'null') || ',"k":' || c_custkey || '}') AS h FROM customer""")
def canonical(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(k, tx.canonical_hash({"k": k, "a": F.when(k % 3 > 0, F.col("c_mktsegment"))}).alias("h"))


@query("f29_f36_f37_lists", "SELECT p_partkey, CASE WHEN contains(p_type, 'COPPER') THEN 'COPPER' WHEN contains(p_type, 'TIN') THEN 'TIN' WHEN contains(p_type, 'STEEL') THEN 'STEEL' END AS metal, CASE WHEN p_size > 25 THEN p_brand || '_' || p_size ELSE p_brand END AS event_key FROM part")
def lists(spark, sf):
    key = F.when(F.col("p_size") > 25, F.concat_ws("_", "p_brand", F.col("p_size").cast("string"))).otherwise(F.col("p_brand"))
    return table(spark, sf, "part").select("p_partkey", tx.first_name_in(F.col("p_type"), ["COPPER", "TIN", "STEEL"]).alias("metal"), key.alias("event_key"))


@query("f35_base64", "SELECT page_id, to_base64(encode(html)) AS b FROM pages")
def base64(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.encoded_base64(F.encode("html", "UTF-8")).alias("b"))


@query("f42_f45_labels", r"""
WITH b AS (SELECT o_orderkey, (CASE o_orderkey % 4 WHEN 0 THEN o_orderkey % 2000 WHEN 1 THEN o_orderkey * 1000 + 1 WHEN 2 THEN o_orderkey * 10000000 ELSE o_orderkey * 100000000000 END)::BIGINT AS n FROM orders)
SELECT o_orderkey, CASE WHEN n < 1024 THEN format('{:.1f} B', n::DOUBLE) WHEN n < 1048576 THEN format('{:.1f} KB', n / 1024.0) WHEN n < 1073741824 THEN format('{:.1f} MB', n / 1048576.0) WHEN n < 1099511627776 THEN format('{:.1f} GB', n / 1073741824.0) ELSE format('{:.1f} TB', n / 1099511627776.0) END AS size,
 regexp_full_match(CAST(o_orderkey + 199990000 AS VARCHAR), '[2-7][0-9]{8}') AS vessel FROM b""")
def labels(spark, sf):
    k = F.col("o_orderkey")
    size = F.when(k % 4 == 0, k % 2000).when(k % 4 == 1, k * 1000 + 1).when(k % 4 == 2, k * 10_000_000).otherwise(k * 100_000_000_000)
    return table(spark, sf, "orders").select(k, tx.human_bytes(size).alias("size"), tx.is_vessel_id((k + 199990000).cast("string")).alias("vessel"))


@query("p18_mojibake", r"SELECT doc_id FROM documents WHERE NOT regexp_matches(coalesce(text, ''), '[\x{0400}-\x{04FF}]')")
def mojibake(spark, sf):
    return table(spark, sf, "documents").filter(~tx.is_mojibake(F.col("text"))).select("doc_id")


@query("p8_aliases", "SELECT c_custkey, coalesce(nullif(trim(CASE WHEN c_custkey % 2 = 0 THEN ' ' ELSE c_name END), ''), nullif(trim(c_mktsegment), '')) AS name FROM customer")
def aliases(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", tx.first_filled(F.when(F.col("c_custkey") % 2 == 0, " ").otherwise(F.col("c_name")), F.col("c_mktsegment")).alias("name"))


@query("r5_sentinels", "SELECT c_custkey, CASE WHEN c_acctbal > -99 THEN CAST(round(c_acctbal * 100) AS BIGINT) END AS cents FROM customer")
def sentinels(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.round(tx.sentinel(F.col("c_acctbal"), -99) * 100).cast("long").alias("cents"))


@query("x1_x2_x5_wkt", """
SELECT user_id, 'SRID=4326;POINT(' || printf('%.6f', 121 + (min(event_id) % 89) / 1000.0) || ' ' || printf('%.6f', 24 + (min(event_id) % 97) / 1000.0) || ')' AS first,
CASE WHEN count(*) >= 2 THEN 'SRID=4326;LINESTRING(' || string_agg(printf('%.6f', 121 + (event_id % 89) / 1000.0) || ' ' || printf('%.6f', 24 + (event_id % 97) / 1000.0), ', ' ORDER BY event_id) || ')' END AS line FROM events GROUP BY 1""")
def wkt(spark, sf):
    e = F.col("event_id")
    p = table(spark, sf, "events").select("user_id", F.struct(e.alias("k"), (F.lit(121.0) + (e % 89) / F.lit(1000.0)).alias("lng"), (F.lit(24.0) + (e % 97) / F.lit(1000.0)).alias("lat")).alias("p"))
    a = p.groupBy("user_id").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    return a.select("user_id", geo.point_wkt(F.col("ps")[0]["lng"], F.col("ps")[0]["lat"]).alias("first"), geo.line_wkt(F.col("ps")).alias("line"))


@query("x11_projection", """
WITH p AS (SELECT event_id, (event_id % 89) / 1000.0::DOUBLE AS x, (event_id % 97) / 1000.0::DOUBLE AS y FROM events), s AS (SELECT *, greatest(0, least(1, x / 0.05)) AS t1, greatest(0, least(1, (y) / 0.08)) AS t2 FROM p),
d AS (SELECT *, sqrt(pow(x - t1 * 0.05, 2) + pow(y, 2)) AS d1, sqrt(pow(x - 0.05, 2) + pow(y - t2 * 0.08, 2)) AS d2 FROM s)
SELECT event_id, CASE WHEN abs(d1 - d2) > 1e-9 THEN round(CASE WHEN d1 <= d2 THEN t1 * 0.05 ELSE 0.05 + t2 * 0.08 END / 0.13, 6) END AS along FROM d""")
def projection(spark, sf):
    """Progress along an L-shaped line on the equator's scale; null for points as near to one leg as to the other."""
    e = F.col("event_id")
    x, y = (e % 89) / F.lit(1000.0), (e % 97) / F.lit(1000.0)
    pt = lambda a, b: F.struct(F.lit(a).alias("lng"), F.lit(b).alias("lat"))
    t1, t2 = (F.greatest(F.lit(0.0), F.least(F.lit(1.0), v)) for v in (x / 0.05, y / 0.08))
    d1 = F.sqrt(F.pow(x - t1 * 0.05, 2) + F.pow(y, 2))
    d2 = F.sqrt(F.pow(x - 0.05, 2) + F.pow(y - t2 * 0.08, 2))
    along = F.round(geo.project_on_line(x, y, F.array(pt(0.0, 0.0), pt(0.05, 0.0), pt(0.05, 0.08)))["along"], 6)
    return table(spark, sf, "events").select("event_id", F.when(F.abs(d1 - d2) > 1e-9, along).alias("along"))


@query("x12_x14_x15_rasters", """
WITH c AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS v FROM embeddings)
SELECT vec_id, i::INT AS i, round(CASE WHEN i * 5.625::DOUBLE > 180 THEN i * 5.625::DOUBLE - 360 ELSE i * 5.625::DOUBLE END, 6) AS lng, CAST(least(greatest(round((v + 1) / 2 * 255), 0), 255) AS INT) AS q FROM c""")
def rasters(spark, sf):
    c = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v"))
    v = F.col("v").cast("double")
    return c.select("vec_id", "i", F.round(geo.wrap_longitude(F.col("i") * F.lit(5.625)), 6).alias("lng"), geo.quantise(v, F.lit(-1.0), F.lit(1.0)).alias("q"))


@query("f22_title_simhash", r"""
WITH t AS (SELECT p_partkey, lower(regexp_replace(p_name, '[^\p{L}\p{N}]', '', 'g')) AS t FROM part),
g AS (SELECT p_partkey, ('0x' || substr(md5(substr(t, i::INT, 2)), 1, 16))::UBIGINT AS h FROM t, generate_series(1, greatest(length(t) - 1, 1)) AS s(i)),
b AS (SELECT p_partkey, k, sum((h >> k) & 1) * 2 > count(*) AS one FROM g, range(64) AS r(k) GROUP BY ALL)
SELECT p_partkey, sum(CASE WHEN one THEN (1::HUGEINT << k) ELSE 0 END)::UBIGINT::VARCHAR AS simhash FROM b GROUP BY p_partkey""")
def title_simhash(spark, sf):
    """64-bit fingerprints of part names, unsigned."""
    titles = table(spark, sf, "part").select("p_partkey", tx.clean_title(F.col("p_name")).alias("title"))
    return dedup.signatures(titles, "title", "sig").select("p_partkey", tx.to_unsigned(F.col("sig")).cast("string").alias("simhash"))


@query("t7_near_titles")
def near_titles(spark, sf):
    """Part names that come in order of their key, one each hour, without those that resemble a name kept in the seven days before; brute force in the tests."""
    titles = table(spark, sf, "part").select(F.col("p_partkey").alias("seq"), (F.col("p_partkey") * 3600).alias("at"), tx.clean_title(F.col("p_name")).alias("title"))
    return dedup.greedy_keep(dedup.signatures(titles, "title", "sig").select("seq", "at", "sig"), horizon=7 * 86400).select(F.col("seq").alias("p_partkey"))


@query("f36_intensity", "SELECT event_id, CASE event_id % 9 WHEN 0 THEN 0 WHEN 1 THEN 4 WHEN 2 THEN 5 WHEN 3 THEN 6 WHEN 4 THEN 7 WHEN 5 THEN 8 WHEN 6 THEN 9 WHEN 7 THEN 5 END::INT AS rank FROM events")
def intensity(spark, sf):
    text = F.element_at(F.array(*map(F.lit, ("0級", "4級", "5弱", "5強 ", "6級", "6強", "7級", "5級", "unknown"))), (F.col("event_id") % 9 + 1).cast("int"))
    return table(spark, sf, "events").select("event_id", tx.intensity_rank(text).alias("rank"))


@query("f41_intervals", "SELECT o_orderkey, strftime(CAST(o_orderdate AS TIMESTAMP) - to_days((o_orderkey % 9)::INT) - to_hours((o_orderkey % 7)::INT), '%Y-%m-%d %H') AS since FROM orders")
def intervals(spark, sf):
    back = F.make_interval(days=(F.col("o_orderkey") % 9).cast("int"), hours=(F.col("o_orderkey") % 7).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(F.col("o_orderdate").cast("timestamp_ntz") - back, "yyyy-MM-dd HH").alias("since"))


@query("f44_stable_names", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN upper(p_brand) WHEN 1 THEN upper(p_brand) WHEN 2 THEN (p_size * 2) || '%' ELSE upper(p_brand) || p_size END AS name FROM part")
def stable_names(spark, sf):
    """Names that end in a load share go without it; a name that is only a share stays, and so do bare figures."""
    k, share = F.col("p_partkey") % 4, F.concat((F.col("p_size") * 2).cast("string"), F.lit("%"))
    name = F.when(k == 0, F.concat(F.lower("p_brand"), F.lit(" -"), share)).when(k == 1, F.concat("p_brand", F.lit("_"), share, F.lit(" "))).when(k == 2, share).otherwise(F.concat("p_brand", F.col("p_size").cast("string")))
    return table(spark, sf, "part").select("p_partkey", tx.without_share(name).alias("name"))


@query("p7_scalar_or_list", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 0 WHEN c_custkey % 3 = 1 THEN 1 ELSE 2 END::INT AS n, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS first FROM customer")
def scalar_or_list(spark, sf):
    """A JSON field that holds one value, a list of values or nothing."""
    k, one = F.col("c_custkey") % 3, F.concat(F.lit('"'), F.col("c_mktsegment"), F.lit('"'))
    field = F.when(k == 0, F.lit("null")).when(k == 1, one).otherwise(F.concat(F.lit("["), one, F.lit(',"x"]')))
    values = tx.as_list(F.get_json_object(F.concat(F.lit('{"v":'), field, F.lit("}")), "$.v"))
    return table(spark, sf, "customer").select("c_custkey", F.size(values).alias("n"), F.get(values, F.lit(0)).alias("first"))


@query("x12_pixels", "SELECT event_id, round(118 + (event_id % 640) * 0.01, 6) AS lng, round(27 - (event_id % 480) * 0.0125, 6) AS lat, sqrt(pow((event_id % 5) * 0.01, 2) + pow((event_id % 3) * 0.01, 2)) <= 0.03 AS ok FROM events")
def pixels(spark, sf):
    e, at = F.col("event_id"), geo.pixel_to_lonlat(F.col("event_id") % 640, F.col("event_id") % 480, 118.0, 27.0, 0.01, 0.0125)
    return table(spark, sf, "events").select("event_id", F.round(at["lng"], 6).alias("lng"), F.round(at["lat"], 6).alias("lat"), geo.within_gate((e % 5) * F.lit(0.01), (e % 3) * F.lit(0.01), 0.03).alias("ok"))


@query("x9_multi_polygons", """
SELECT s_nationkey, 'SRID=4326;MULTIPOLYGON(' || string_agg(printf('((%.6f %.6f, %.6f %.6f, %.6f %.6f, %.6f %.6f))', s_suppkey / 100.0, 1.0, s_suppkey / 100.0 + 1, 1.0, s_suppkey / 100.0, 2.0, s_suppkey / 100.0, 1.0), ', ' ORDER BY s_suppkey) || ')' AS wkt FROM supplier GROUP BY 1""")
def multi_polygons(spark, sf):
    """Rings of one nation's suppliers collected into one geometry, in order of their key."""
    x, pt = F.col("s_suppkey") / F.lit(100.0), lambda a, b: F.struct(a.alias("lng"), F.lit(b).alias("lat"))
    ring = F.array(pt(x, 1.0), pt(x + 1, 1.0), pt(x, 2.0), pt(x, 1.0))
    rings = F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", ring.alias("ring")))), lambda r: r["ring"])
    return table(spark, sf, "supplier").groupBy("s_nationkey").agg(geo.multi_wkt(rings).alias("wkt"))
