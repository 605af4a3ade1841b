"""Round trips of the feeds' formats: rows of a table are rendered into the format, and a reader brings them back.

Files go below the session's shared folder. Rendered files hold a bounded number of rows each, as the feeds' snapshots do.
"""

from __future__ import annotations

import io
import json
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwharf.functions import text as tx
from sparkwharf.operators import statistics as st
from sparkwharf.plans.register import query, table
from sparkwharf.sources import files, paged, sinks, specs
from sparkwharf.sources.shared import folder

#: Rows of one rendered file.
ROWS = 500
BOM = "﻿"


def rendered(rows: DataFrame, key: str, content: Column, name: str, head: Column | None = None, tail: str = "", between: str = "\n") -> str:
    """Write one text file for each ROWS keys: a head, the rows' contents in order of the key, a tail."""
    path = folder(rows.sparkSession, name)
    groups = rows.select(F.floor(F.col(key) / ROWS).alias("bucket"), F.struct(F.col(key).alias("k"), content.alias("c")).alias("r"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["c"]), between)
    made = groups.groupBy("bucket").agg(body.alias("body"))
    made.select("bucket", F.concat(F.lit("") if head is None else head, F.col("body"), F.lit(tail)).alias("value")).repartition("bucket").write.partitionBy("bucket").option("lineSep", "\n").text(path)
    return path


def zipped(rows: DataFrame, name: str, pack) -> DataFrame:
    """``path, content``: an archive of each row's ``member`` and ``body``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [pack(m, b.encode()) for m, b in zip(batch.column("member").to_pylist(), batch.column("body").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([f"{name}/{m}" for m in batch.column("member").to_pylist()]), pa.array(made, pa.binary())], ["path", "content"])

    return rows.select("member", "body").mapInArrow(run, "path string, content binary")


def tar_gz(member: str, body: bytes) -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as t:
        info = tarfile.TarInfo(member)
        info.size = len(body)
        t.addfile(info, io.BytesIO(body))
    return out.getvalue()


def kmz(member: str, body: bytes) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(member, body)
    return out.getvalue()


@query("s2_json_arrays", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def json_arrays(spark, sf):
    s = table(spark, sf, "supplier")
    path = rendered(s, "s_suppkey", F.to_json(F.struct("s_suppkey", "s_name", "s_nationkey")), "json", F.lit("["), "]", ",\n")
    return files.json_arrays(spark, path, "s_suppkey long, s_name string, s_nationkey long").drop("_file", "bucket")


#: Rows of a stored page, which is not that of a fetched one.
STORED = 400


def stored_feed(spark, sf) -> tuple[str, int]:
    """A server's pages: the events of each type by number, as JSON lines; and how many the largest type has."""
    events = table(spark, sf, "events").select(F.col("event_type").alias("key"), "event_id")
    counts = events.groupBy("key").agg(F.count(F.lit(1)).alias("n"))  # a row a type
    before = counts.select("key", (F.sum("n").over(Window.orderBy("key")) - F.col("n")).alias("before"))
    # the types are few, so their rows are ranked over all ranges of the order, not in a task a type
    ranked = st.global_rank(events, [F.col("key"), F.col("event_id")], "i").join(F.broadcast(before), "key")
    path = folder(spark, "pages")
    rows = ranked.withColumn("from", F.floor((F.col("i") - F.col("before") - 1) / STORED) * STORED).select("key", "from", "event_id")
    # a page is one file, in order
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartition(parts, "key", "from").sortWithinPartitions("key", "from", "event_id").write.partitionBy("key", "from").json(path)
    return path, counts.agg(F.max("n")).first()[0]


@query("s1_s3_s4_paged", """
WITH n AS (SELECT CAST(ceil(max(c) / 300.0) AS BIGINT) AS pages FROM (SELECT count(*) AS c FROM events GROUP BY event_type))
SELECT event_type AS city, event_id, false AS failed FROM events UNION ALL SELECT 'closed', NULL, true FROM n, unnest(range(pages)) r(i)""")
def paged_feed(spark, sf):
    """Pages of each type, fetched in parallel; one whose server has nothing fails by itself, a row a page."""
    path, most = stored_feed(spark, sf)
    spark.dataSource.register(paged.PagedSource)
    keys = [r["event_type"] for r in table(spark, sf, "events").select("event_type").distinct().collect()]  # the types of events
    options = {"keys": json.dumps([*keys, "closed"]), "pagesize": "300", "total": str(most), "fetch": "sparkwharf.sources.paged.stored_page", "stored": str(STORED), "folder": path}
    raw = spark.read.format("paged").options(**options).load()
    return raw.select(F.col("key").alias("city"), F.get_json_object("row", "$.event_id").cast("long").alias("event_id"), F.col("error").isNotNull().alias("failed"))


@query("s1_t16_polled", "SELECT event_type AS key, event_id FROM events")
def polled_feed(spark, sf):
    """The same pages as a stream that polls, a few pages a batch, into a table; every row once."""
    path, _ = stored_feed(spark, sf)
    spark.dataSource.register(paged.PagedSource)
    keys = [r["event_type"] for r in table(spark, sf, "events").select("event_type").distinct().collect()]
    options = {"keys": json.dumps(keys), "pagesize": "500", "limit": "40", "fetch": "sparkwharf.sources.paged.stored_page", "upto": "sparkwharf.sources.paged.stored_count", "stored": str(STORED), "folder": path}
    polled, marks = folder(spark, "polled"), folder(spark, "polled-marks")
    rows = spark.readStream.format("paged").options(**options).load().select("key", F.get_json_object("row", "$.event_id").cast("long").alias("event_id"))
    running = rows.writeStream.format("parquet").option("checkpointLocation", marks).trigger(availableNow=True).start(polled)
    running.awaitTermination()
    return spark.read.schema("key string, event_id long").parquet(polled)


@query("s5_csv_positional", "SELECT c_custkey, c_mktsegment, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer")
def csv_positional(spark, sf):
    c = table(spark, sf, "customer")
    line = F.concat_ws(",", "c_custkey", F.concat(F.lit('"'), F.col("c_mktsegment"), F.lit('"')), F.round(F.col("c_acctbal") * 100).cast("long"))
    read = files.csv_positional(spark, rendered(c, "c_custkey", line, "csv", F.lit(BOM)), ["c_custkey", "c_mktsegment", "cents"])
    return read.select(F.col("c_custkey").cast("long"), "c_mktsegment", F.col("cents").cast("long"))


@query("s6_csv_aliased", "SELECT c_custkey, c_mktsegment AS segment FROM customer")
def csv_aliased(spark, sf):
    """Every other file calls the segment otherwise."""
    c = table(spark, sf, "customer")
    head = F.concat(F.lit(BOM + "id,"), F.when(F.col("bucket") % 2 == 0, "segment").otherwise("市場"), F.lit("\n"))
    read = files.csv_aliased(spark, rendered(c, "c_custkey", F.concat_ws(",", "c_custkey", "c_mktsegment"), "aliased", head) + "/*", {"c_custkey": ["key", "id"], "segment": ["segment", "市場"]})
    return read.select(F.col("c_custkey").cast("long"), "segment")


@query("s7_cap_alerts", """
SELECT 'alert-' || c_custkey AS identifier, CASE WHEN c_acctbal < 0 THEN 'Severe' ELSE 'Minor' END AS severity, c_mktsegment AS event, c_nationkey::VARCHAR || '.5,121.5 0.2' AS circle FROM customer""")
def cap_alerts(spark, sf):
    xml = F.concat(
        F.lit('<cap:alert xmlns:cap="urn:oasis:names:tc:emergency:cap:1.2"><cap:identifier>alert-'), F.col("c_custkey"), F.lit("</cap:identifier><cap:sender>s</cap:sender><cap:info><cap:event>"),
        F.col("c_mktsegment"), F.lit("</cap:event><cap:severity>"), F.when(F.col("c_acctbal") < 0, "Severe").otherwise("Minor"),
        F.lit("</cap:severity><cap:area><cap:areaDesc>x</cap:areaDesc><cap:circle>"), F.col("c_nationkey").cast("string"), F.lit(".5,121.5 0.2</cap:circle></cap:area></cap:info></cap:alert>"),
    )
    a = files.cap_alerts(table(spark, sf, "customer").select(xml.alias("xml")))
    return a.select("identifier", "severity", "event", F.get(F.get("area", F.lit(0))["circle"], F.lit(0)).alias("circle"))


@query("s8_flat_xml", "SELECT n_nationkey, n_name FROM nation")
def flat_xml(spark, sf):
    path = folder(spark, "xml")
    table(spark, sf, "nation").select("n_nationkey", "n_name").write.format("xml").options(rootTag="nations", rowTag="nation").save(path)
    return files.xml_rows(spark, path, "nation", "n_nationkey long, n_name string")


@query("s9_kmz", "SELECT s_name AS name, 121 + s_suppkey % 7 * 0.5 AS lng, 24.5::DOUBLE AS lat FROM supplier")
def kmz_marks(spark, sf):
    lng = F.lit(121.0) + F.col("s_suppkey") % 7 * F.lit(0.5)
    body = F.concat(F.lit("<kml><Placemark><name><![CDATA["), F.col("s_name"), F.lit("]]></name><Point><coordinates>"), lng.cast("string"), F.lit(",24.5,0</coordinates></Point></Placemark></kml>"))
    made = zipped(table(spark, sf, "supplier").select(F.lit("doc.kml").alias("member"), body.alias("body")), "kmz", kmz)
    return files.kmz_placemarks(made).select("name", "lng", "lat")


@query("s10_rss_atom", "SELECT 'rss' AS kind, p_name AS title, 'http://x/' || p_partkey AS link FROM part UNION ALL SELECT 'atom', p_name, 'http://x/' || p_partkey FROM part")
def rss_atom(spark, sf):
    p, link = table(spark, sf, "part"), F.concat(F.lit("http://x/"), F.col("p_partkey"))
    item = F.concat(F.lit("<item><title>"), F.col("p_name"), F.lit("</title><link>"), link, F.lit("</link></item>"))
    entry = F.concat(F.lit("<entry><title>"), F.col("p_name"), F.lit('</title><link href="'), link, F.lit('"></link></entry>'))
    rss = files.rss_items(spark, rendered(p, "p_partkey", item, "rss", F.lit("<rss><channel>"), "</channel></rss>"))
    atom = files.atom_entries(spark, rendered(p, "p_partkey", entry, "atom", F.lit("<feed>"), "</feed>"))
    return rss.select(F.lit("rss").alias("kind"), "title", "link").unionByName(atom.select(F.lit("atom").alias("kind"), "title", "link"))


@query("s11_html_container", "SELECT c_custkey, '<div>' || c_mktsegment || '</div><p>' || c_custkey || '</p>' AS main FROM customer")
def html_container(spark, sf):
    page = F.concat(F.lit('<div class="top"><div>no</div></div><div id="m" class="wide main"><div>'), F.col("c_mktsegment"), F.lit("</div><p>"), F.col("c_custkey"), F.lit("</p></div><div>after</div>"))
    return files.html_main(table(spark, sf, "customer").select("c_custkey", page.alias("html")), "html", "main", "main").drop("html")


@query("s12_geojson", "SELECT s_name AS name, (121 + s_suppkey % 7 * 0.5)::DOUBLE AS lng, 24.5::DOUBLE AS lat FROM supplier")
def geojson(spark, sf):
    point = F.struct(F.lit("Point").alias("type"), F.array(F.lit(121.0) + F.col("s_suppkey") % 7 * F.lit(0.5), F.lit(24.5)).alias("coordinates"))
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.col("s_name").alias("name")).alias("properties"), point.alias("geometry")))
    path = rendered(table(spark, sf, "supplier"), "s_suppkey", feature, "geojson", F.lit('{"type":"FeatureCollection","features":['), "]}", ",")
    return files.geojson_features(spark, path, "name: string")


@query("s13_partitioned_scan", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def partitioned_scan(spark, sf):
    """The filter prunes the folders of the other partitions."""
    path = folder(spark, "orders")
    table(spark, sf, "orders").write.partitionBy("o_orderstatus").parquet(path)
    return spark.read.parquet(path).filter("o_orderstatus = 'F'").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("s18_tar_json", "SELECT n_nationkey, n_name FROM nation")
def tar_json(spark, sf):
    n = table(spark, sf, "nation")
    one = F.to_json(F.struct("n_nationkey", "n_name"))
    body = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("["), one, F.lit("]"))).otherwise(one)
    made = zipped(n.select(F.concat(F.col("n_name"), F.lit(".json")).alias("member"), body.alias("body")), "tar", tar_gz)
    return files.tar_json(made, "n_nationkey: long, n_name: string").select("n_nationkey", "n_name")


@query("s19_dated_union", "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 3 = 0 UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 3 > 0")
def dated_union(spark, sf):
    s, one = table(spark, sf, "supplier"), F.to_json(F.struct("s_suppkey", "s_name"))
    old, new = (rendered(s.filter(c), "s_suppkey", one, n, F.lit("["), "]", ",") for c, n in (("s_suppkey % 3 = 0", "old"), ("s_suppkey % 3 > 0", "new")))
    return files.dated_union(spark, old, new, "s_suppkey long, s_name string").drop("_file", "bucket")


@query("s24_first_source", "SELECT event_id FROM events WHERE CASE WHEN ts::DATE < DATE '2024-01-15' THEN event_type = 'view' ELSE event_type = 'click' END")
def first_source(spark, sf):
    """Days up to the middle of the month are held by the first source, the others by the second only."""
    ev = table(spark, sf, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    late = F.col("day") >= F.lit("2024-01-15").cast("date")
    first, second = ev.filter((F.col("event_type") == "view") & ~late), ev.filter(F.col("event_type") == "click")
    return files.first_source_by_day(ev.select("day").distinct(), first, second).select("event_id")


@query("s26_bulletins", """
SELECT s_suppkey, i::INT AS i, '0' || (1 + i) || '0600Z' AS "group", (CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE -1 END) * (12.5 + i) AS lat, (CASE WHEN s_suppkey % 3 = 0 THEN -1 ELSE 1 END) * 130.1::DOUBLE AS lng,
CASE WHEN i = 0 THEN 'observed' ELSE 'forecast' END AS kind FROM supplier, range(3) r(i)""")
def bulletins(spark, sf):
    k = F.col("s_suppkey")
    line = lambda i: F.concat(F.lit(f"0{1 + i}0600Z --- {'NEAR ' if not i else ''}{12.5 + i}"), F.when(k % 2 == 0, "N").otherwise("S"), F.lit(" 130.1"), F.when(k % 3 == 0, "W").otherwise("E"))
    text = F.concat_ws("\n", F.lit("WARNING NR 1"), *[line(i) for i in range(3)], F.lit("REMARKS: none"))
    return files.storm_bulletins(table(spark, sf, "supplier").select(k, text.alias("text"))).select("s_suppkey", "i", "group", "lat", "lng", "kind")


@query("s27_storm_points", "SELECT n_name AS storm, h::INT AS hour, CASE WHEN h = 0 THEN 'observed' ELSE 'forecast' END AS kind FROM nation, (VALUES (0), (12), (24)) v(h)")
def storm_points(spark, sf):
    points = F.from_json(F.lit('[{"hour":0},{"hour":12},{"hour":24}]'), "array<struct<hour: int>>")
    return files.storm_points(table(spark, sf, "nation").select(F.col("n_name").alias("storm"), points.alias("points"))).select("storm", "hour", "kind")


@query("k19_k22_arrow_export", "SELECT c_custkey, c_mktsegment FROM customer")
def arrow_export(spark, sf):
    """Written as Arrow files, counted back against what was sent, and read again."""
    c, path, held = table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), folder(spark, "arrow"), []
    sinks.verified_export(c, lambda rows: held.append(sinks.export_arrow(rows, path)), lambda: held[0].agg(F.sum("n")).first()[0])
    return sinks.read_arrow(held[0], path, "c_custkey long, c_mktsegment string")


@query("k20_json_export", "SELECT s_suppkey, s_name FROM supplier")
def json_export(spark, sf):
    path = folder(spark, "json_export")
    sinks.export_json_array(table(spark, sf, "supplier").select("s_suppkey", "s_name"), path)
    return files.json_arrays(spark, path, "s_suppkey long, s_name string").drop("_file", "bucket")


@query("k21_csv_export", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1997-01-01'")
def csv_export(spark, sf):
    """The days of a range."""
    path = folder(spark, "csv_export")
    wanted = (F.col("o_orderdate") >= F.lit("1996-01-01").cast("date")) & (F.col("o_orderdate") < F.lit("1997-01-01").cast("date"))
    sinks.export_csv(table(spark, sf, "orders").filter(wanted).select("o_orderkey", "o_orderstatus"), path)
    return spark.read.schema("o_orderkey long, o_orderstatus string").option("header", True).csv(path)


#: Feeds with their tables: what arrives, how it is made clean, and where it goes.
FEEDS = specs.Registry()
FEEDS.add(specs.TableSpec("port_current", specs.schema_of("vessel string, lat double, lng double, seen long"), ("vessel",), "current", "seen", 10, True, source="ships"))
FEEDS.add(specs.TableSpec("port_history", specs.schema_of("vessel string, lat double, lng double, seen long"), (), "append", "seen", 10, source="ships"))
FEEDS.add(specs.TableSpec("lots", specs.schema_of("lot string, total int, free int"), ("lot",), "upsert", None, 30, source="parking"))
FEEDS.add(specs.TableSpec("alerts", specs.schema_of("alert string, severity string"), ("alert",), "insert_absent", None, 5, source="alerts"))
FEEDS.add(specs.TableSpec("names", specs.schema_of("place string, county string"), ("place",), "upsert", source="places"))


@specs.normaliser("ships")
def clean_ships(rows: DataFrame) -> DataFrame:
    """Vessels with a valid number; positions out of the world become null."""
    inside = F.col("lat").try_cast("double").between(-90, 90) & F.col("lng").try_cast("double").between(-180, 180)
    at = [F.when(inside, F.col(c)).alias(c) for c in ("lat", "lng")]
    return rows.filter(tx.is_vessel_id(F.col("mmsi"))).select(F.col("mmsi").alias("vessel"), *at, "seen")


@specs.normaliser("parking")
def clean_lots(rows: DataFrame) -> DataFrame:
    return rows.select(F.trim("name").alias("lot"), "total", F.when(F.col("free").try_cast("int") >= 0, F.col("free")).alias("free"))


@specs.normaliser("alerts")
def clean_alerts(rows: DataFrame) -> DataFrame:
    return rows.filter("id IS NOT NULL").select(F.col("id").alias("alert"), F.initcap("level").alias("severity"))


@specs.normaliser("places")
def clean_places(rows: DataFrame) -> DataFrame:
    return rows.select(F.regexp_replace(F.lower("name"), r"\s+", "").alias("place"), F.translate("county", "台", "臺").alias("county"))


@query("s25_d3_feeds", "SELECT event_id, CAST(event_id + 200000000 AS VARCHAR) AS vessel, CASE WHEN event_id % 4 > 0 THEN 24.5 END::DOUBLE AS lat, event_id AS seen FROM events WHERE event_id % 2 = 0")
def feeds(spark, sf):
    """Raw rows of a source through its normaliser onto its declared table; half of the numbers are no vessels'."""
    e = F.col("event_id")
    raw = table(spark, sf, "events").select(F.when(e % 2 == 0, (e + 200000000).cast("string")).otherwise("x").alias("mmsi"), F.when(e % 4 > 0, "24.5").otherwise("99.0").alias("lat"), F.lit("121.5").alias("lng"), e.cast("string").alias("seen"))
    spec = next(s for s in FEEDS.of_source("ships") if s.mode == "append")
    clean = specs.conform(specs.NORMALISERS["ships"](raw), spec)
    return clean.select(F.col("seen").alias("event_id"), "vessel", "lat", "seen")
