"""Operator 10: line deduplication by range-partitioned line hashes.

Lines are reduced to 128-bit hashes of their keys. The hashes are dealt out in
ranges with a secondary sort by document and position, so that each task
streams every key's occurrences in document order and sees the first one.
What comes back is, per document, a run-length keep bitmap; text is only
touched again where a caller applies the bitmap. Everything is DataFrame code.

Cases: a null or empty text is one empty line; lines whose key is shorter than
``min_key`` code points are always kept; rows that repeat both id and text count
as one document and get the same bitmap; a null id is an id like any other, so all rows without an id count as
one document; an empty table gives an empty result; other columns are carried, whatever their names, but the
added ones may not be there already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkwharf.llm.common import MAX_HEAVY_KEYS, ascii_lower, free_names, staged, with_fields

#: Space and the controls from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
#: Lines that the tests plan for in one task of the range step.
MIN_HEAVY_ROWS = 64


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def line_hashes(docs: DataFrame, min_key: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line: ``id, f`` (tells apart texts under one id), ``pos, h`` (null: key too short)."""
    lines = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(text_col)).alias("f"),
        F.posexplode(text_lines(F.col(text_col))).alias("pos", "line"),
    )
    key = line_key(F.col("line"))
    return lines.select("id", "f", "pos", F.when(F.length(key) >= min_key, F.unhex(F.md5(key))).alias("h"))


def line_flags(hashes: DataFrame, min_docs: int, keep_first: bool) -> DataFrame:
    """``hashes`` with a boolean ``dropped``.

    A key found in at least ``min_docs`` documents loses its lines:
    all of them, or with ``keep_first`` all but the first by id and position.
    Keys with more than one in MAX_HEAVY_KEYS of all lines are counted by a
    combining aggregate and broadcast (they are at most that many); all others
    go through the range-partitioned stream, where no key can be hot.
    """
    n_lines = hashes.count()
    at = F.struct(F.col("id"), F.col("f"), F.col("pos"))
    keyed = hashes.filter(F.col("h").isNotNull())
    heavy = (
        keyed.groupBy("h", "id")
        .agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first"))
        .groupBy("h")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_docs"), F.min("first").alias("first"))
        .filter(F.col("n") >= max(MIN_HEAVY_ROWS, n_lines // MAX_HEAVY_KEYS + 1))
        .drop("n")
    )
    heavy = F.broadcast(staged(heavy, "heavy_lines"))
    over = F.col("n_docs") >= min_docs
    hot = keyed.join(heavy, "h").withColumn("dropped", over & ~(F.lit(keep_first) & (at == F.col("first"))))
    light = keyed.join(heavy.select("h"), "h", "left_anti").repartitionByRange("h")
    by_key = Window.partitionBy("h").orderBy("id", "f", "pos")
    new_doc = (F.row_number().over(by_key) == 1) | ~F.lag("id").over(by_key).eqNullSafe(F.col("id"))
    streamed = (
        light.withColumn("new_doc", new_doc.cast("int"))
        .withColumn("rank", F.rank().over(by_key))
        .withColumn("n_docs", F.sum("new_doc").over(by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("dropped", over & ~(F.lit(keep_first) & (F.col("rank") == 1)))
    )
    cols = ["id", "f", "pos", "dropped"]
    short = hashes.filter(F.col("h").isNull()).withColumn("dropped", F.lit(False))
    return hot.select(cols).unionByName(streamed.select(cols)).unionByName(short.select(cols))


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_key: int = 1, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``id, f, n_lines, n_dropped, runs``.

    ``runs`` is the keep bitmap as run lengths, alternately kept and dropped,
    beginning with a (possibly empty) kept run.
    """
    hashes = staged(line_hashes(docs, min_key, id_col, text_col), "line_hashes")
    flags = line_flags(hashes, min_docs, keep_first)
    bits = F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("pos", "dropped"))), lambda x: F.when(x["dropped"], "d").otherwise("k")), "")
    per_doc = flags.groupBy("id", "f").agg(bits.alias("bits"))
    runs = F.transform(F.regexp_extract_all("bits", F.lit("(k+|d+)"), F.lit(0)), F.length)
    return per_doc.select(
        "id",
        "f",
        F.length("bits").alias("n_lines"),
        F.length(F.replace("bits", F.lit("k"), F.lit(""))).alias("n_dropped"),
        F.when(F.col("bits").startswith("d"), F.concat(F.array(F.lit(0)), runs)).otherwise(runs).alias("runs"),
    )


def kept_text(text: Column, runs: Column) -> Column:
    """The text without the dropped lines of its keep bitmap."""
    flags = F.flatten(F.transform(runs, lambda n, i: F.array_repeat(i % 2 == 0, n)))
    both = F.arrays_zip(text_lines(text).alias("line"), flags.alias("kept"))
    return F.array_join(F.transform(F.filter(both, lambda x: x["kept"]), lambda x: x["line"]), "\n")


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_key: int = 1, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with columns ``_kept`` (text), ``_n_lines``, ``_n_dropped`` and ``_runs`` added; no row is dropped."""
    with_fields(docs, _kept="string", _n_lines="int", _n_dropped="int", _runs="array<int>")  # refuses names that are taken
    maps, (id_, f_) = keep_bitmaps(docs, min_docs, min_key, keep_first, id_col, text_col), free_names(docs, "_id", "_f")
    maps = maps.select(F.col("id").alias(id_), F.col("f").alias(f_), F.col("n_lines").alias("_n_lines"), F.col("n_dropped").alias("_n_dropped"), F.col("runs").alias("_runs"))
    joined = docs.join(maps, F.col(id_col).eqNullSafe(F.col(id_)) & (F.xxhash64(F.col(text_col)) == F.col(f_)))
    untouched = F.coalesce(F.col(text_col), F.lit(""))
    kept = F.when(F.col("_n_dropped") == 0, untouched).otherwise(kept_text(F.col(text_col), F.col("_runs")))
    return joined.withColumn("_kept", kept).drop(id_, f_)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops the lines whose key is in at least 10 documents; returns digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs, min_docs=10, min_key=1).select(
        "doc_id",
        F.col("_n_lines").cast("long").alias("n_lines"),
        F.col("_n_dropped").cast("long").alias("n_dropped"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), bad AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT coalesce(doc_id::VARCHAR, '')) >= 10
), f AS (
  SELECT k.*, bad.key IS NOT NULL AS dropped FROM k LEFT JOIN bad ON k.key = bad.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM f GROUP BY rid, doc_id
"""
