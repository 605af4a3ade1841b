"""Readers for the feeds' file formats. Schemas are always given, never inferred."""

from __future__ import annotations

import csv
import io
import re
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = "﻿"


def json_arrays(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Snapshot files that hold one JSON array (or one object) each, with the file's path."""
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("_file", F.col("_metadata.file_path"))


def snapshot_time(file: Column) -> Column:
    """The time in paths like ``name/YYYY/MM/DD/name_HHMM.json``."""
    return F.try_to_timestamp(F.regexp_replace(F.regexp_extract(file, r"(\d{4}/\d{2}/\d{2})/[^/]*_(\d{4})\.json", 0), r"^(\d{4}/\d{2}/\d{2})/[^/]*_(\d{4})\.json$", "$1 $2"), F.lit("yyyy/MM/dd HHmm"))


def dated_union(spark: SparkSession, old_path: str, new_path: str, schema: T.StructType | str) -> DataFrame:
    """Two directory layouts of one feed, which both hold the day of the change."""
    return json_arrays(spark, old_path, schema).unionByName(json_arrays(spark, new_path, schema))


def csv_positional(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Headerless CSV, all text, without the byte order mark of the first cell."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.schema(schema).option("header", False).csv(path)
    return rows.withColumn(columns[0], F.regexp_replace(columns[0], "^" + BOM, ""))


def csv_aliased(spark: SparkSession, path: str, aliases: dict[str, list[str]]) -> DataFrame:
    """CSV with a header whose names vary: each column takes the first alias that is there and filled.

    Files are read row by row through Arrow, so that a byte order mark in a header and
    files of different headers are no matter; a file is one partition's work.
    """
    out = list(aliases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = csv.DictReader(io.StringIO(content.as_py().decode("utf-8-sig", "replace")))
                made = [[next((r[a].strip() for a in aliases[c] if (r.get(a) or "").strip()), None) for c in out] for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], pa.string()) for i in range(len(out))], out)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, ", ".join(f"`{c}` string" for c in out))


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str, ignore_namespace: bool = True) -> DataFrame:
    """XML documents decoded from their bytes by their own declaration."""
    return spark.read.format("xml").schema(schema).option("rowTag", row_tag).option("ignoreNamespace", ignore_namespace).load(path)


def rss_items(spark: SparkSession, path: str) -> DataFrame:
    return xml_rows(spark, path, "item", "title string, link string, pubDate string, description string")


def atom_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entries of Atom feeds under the names of RSS items."""
    rows = xml_rows(spark, path, "entry", "title string, link struct<_href: string>, updated string, summary string")
    return rows.select("title", F.col("link._href").alias("link"), F.col("updated").alias("pubDate"), F.col("summary").alias("description"))


def geojson_features(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Features of collections: properties, and longitude and latitude of points."""
    schema = f"features array<struct<properties: struct<{properties}>, geometry: struct<type: string, coordinates: array<double>>>>"
    f = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    point = F.col("f.geometry.type") == "Point"
    return f.select("f.properties.*", F.when(point, F.get("f.geometry.coordinates", F.lit(0))).alias("lng"), F.when(point, F.get("f.geometry.coordinates", F.lit(1))).alias("lat"))


def text_grid(spark: SparkSession, path: str, south: float, west: float, step: float, valid_above: float = -900) -> DataFrame:
    """Grids of numbers, a row a line from the south: one row per valid cell."""
    rows = spark.read.text(path, wholetext=True).withColumn("_file", F.col("_metadata.file_path"))
    lines = rows.select("_file", F.posexplode(F.split(F.trim("value"), "\n")).alias("r", "line"))
    cells = lines.select("_file", "r", F.posexplode(F.split("line", ",")).alias("c", "cell")).withColumn("value", F.trim("cell").try_cast("double"))
    return cells.filter(F.col("value") > valid_above).select("_file", "r", "c", F.round(F.lit(south) + F.col("r") * step, 4).alias("lat"), F.round(F.lit(west) + F.col("c") * step, 4).alias("lng"), "value")


def binary_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path, content`` of files."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _members(files: DataFrame, unpack) -> DataFrame:
    """The members of archives ``files(path, content)``, a row each; one is in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                for name, data in unpack(content.as_py()):
                    yield pa.RecordBatch.from_pydict({"archive": [file], "name": [name], "content": [data]})

    return files.select("path", "content").mapInArrow(run, "archive string, name string, content binary")


def _untar(data: bytes) -> Iterator[tuple[str, bytes]]:
    with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as t:
        for m in t:
            if m.isfile():
                yield m.name, t.extractfile(m).read()


def _unzip(data: bytes) -> Iterator[tuple[str, bytes]]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for name in z.namelist():
            if not name.endswith("/"):
                yield name, z.read(name)


def tar_json(files: DataFrame, schema: str) -> DataFrame:
    """Rows of the JSON files (arrays or objects) in day archives ``files(path, content)``, with archive and member name."""
    members = _members(files, _untar).filter(F.col("name").endswith(".json"))
    text = F.decode("content", "UTF-8")
    rows = F.when(F.trim(text).startswith("["), F.from_json(text, f"array<struct<{schema}>>")).otherwise(F.array(F.from_json(text, f"struct<{schema}>")))
    return members.select("archive", "name", F.explode(rows).alias("r")).select("archive", "name", "r.*")


def kmz_placemarks(files: DataFrame) -> DataFrame:
    """Name, description and point of the placemarks in zipped KML ``files(path, content)``."""
    kml = _members(files, _unzip).filter(F.lower("name").endswith(".kml")).select("archive", F.decode("content", "UTF-8").alias("k"))
    marks = kml.select("archive", F.explode(F.regexp_extract_all("k", F.lit("(?s)<Placemark[^>]*>(.*?)</Placemark>"), F.lit(1))).alias("p"))
    tag = lambda n: F.nullif(F.trim(F.regexp_extract("p", f"(?s)<{n}[^>]*>(?:<!\\[CDATA\\[)?(.*?)(?:\\]\\]>)?</{n}>", 1)), F.lit(""))
    at = F.split(tag("coordinates"), ",")
    return marks.select("archive", tag("name").alias("name"), tag("description").alias("description"), F.get(at, F.lit(0)).try_cast("double").alias("lng"), F.get(at, F.lit(1)).try_cast("double").alias("lat"))


def latest_partition(rows: DataFrame, pattern: str = r"dt=([0-9-]+)") -> DataFrame:
    """The rows of the newest partition named in the files' paths."""
    marked = rows.withColumn("_dt", F.regexp_extract("_file", pattern, 1))
    newest = marked.agg(F.max("_dt").alias("_dt"))  # one row
    return marked.join(F.broadcast(newest), "_dt", "left_semi").drop("_dt")


def first_source_by_day(days: DataFrame, *sources: DataFrame, day: str = "day") -> DataFrame:
    """Rows of each day from the first source that has the day at all."""
    out, left = None, days.select(day).distinct()
    for s in sources:
        mine = s.join(left, day, "left_semi")
        out = mine if out is None else out.unionByName(mine)
        left = left.join(s.select(day).distinct(), day, "left_anti")
    return out


def storm_bulletins(texts: DataFrame, text: str = "text") -> DataFrame:
    """Observed and forecast points of storm bulletins: lines ``ddHHmmZ --- 12.5N 130.1W`` under an hour's heading."""
    line = r"(\d{6}Z)\s+-{2,}\s+(?:NEAR\s+)?(\d+(?:\.\d+)?)([NS])\s+(\d+(?:\.\d+)?)([EW])"
    found = texts.select(*[c for c in texts.columns if c != text], F.posexplode(F.regexp_extract_all(text, F.lit(line), F.lit(0))).alias("i", "l"))
    part = lambda k: F.regexp_extract("l", line, k)
    sign = lambda k, minus: F.when(part(k) == minus, -1.0).otherwise(1.0)
    return found.select(
        *[c for c in texts.columns if c != text], "i", part(1).alias("group"), (part(2).cast("double") * sign(3, "S")).alias("lat"), (part(4).cast("double") * sign(5, "W")).alias("lng"),
        F.when(F.col("i") == 0, "observed").otherwise("forecast").alias("kind"),
    )


def storm_points(advisories: DataFrame) -> DataFrame:
    """Points of JSON advisories: observed at hour 0, else forecast."""
    p = advisories.select("storm", F.explode("points").alias("p")).select("storm", "p.*")
    return p.withColumn("kind", F.when(F.col("hour") == 0, "observed").otherwise("forecast"))


def html_main(rows: DataFrame, html: str, container: str, name: str) -> DataFrame:
    """``rows`` with the inner HTML of the first div of a class, up to the end tag that closes it; null without one."""
    opened = re.compile(rf'<div\b[^>]*\bclass="(?:[^"]*\s)?{re.escape(container)}(?:\s[^"]*)?"[^>]*>', re.I)
    tag = re.compile(r"<(/?)div\b[^>]*>", re.I)

    def inner(page: str | None) -> str | None:
        start = opened.search(page or "")
        depth = 1
        for m in tag.finditer(page, start.end()) if start else ():
            depth += -1 if m[1] else 1
            if not depth:
                return page[start.end() : m.start()]
        return page[start.end() :] if start else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([inner(t.as_py()) for t in batch.column(html)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())]))


def cap_alerts(texts: DataFrame, text: str = "xml") -> DataFrame:
    """Fields of alert documents, one row per info block."""
    schema = "identifier string, sender string, sent string, status string, msgType string, info array<struct<event string, severity string, urgency string, certainty string, effective string, onset string, expires string, headline string, description string, instruction string, senderName string, area array<struct<areaDesc string, polygon array<string>, circle array<string>>>>>"
    # prefixes such as cap: go, so that names match with and without them
    bare = F.regexp_replace(F.regexp_replace(text, r"<(/?)\w+:", "<$1"), r'\sxmlns(:\w+)?="[^"]*"', "")
    parsed = texts.select(F.from_xml(bare, schema).alias("a")).select("a.*")
    return parsed.select("identifier", "sender", "sent", "status", F.col("msgType").alias("msg_type"), F.explode_outer("info").alias("i")).select("identifier", "sender", "sent", "status", "msg_type", "i.*")
