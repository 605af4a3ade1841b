"""A corpus pipeline of five stages over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet in the shared folder and read again as the next one's docs. All but the last
return the columns of ``documents``; other columns that docs may have, whatever their names, are carried
by those four and ignored by the last.

Cases: null and empty texts pass every stage, but are copies of one another for the third; null ids come
after all others there and are otherwise ids like any; rows that repeat id and text are one document from the third stage on; very long texts are
worked on whole; without documents, labels or benchmark items a stage returns what it was given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwharf.llm import decontaminate, line_dedup, near_copies, toxicity, unigram
from sparkwharf.llm.common import delete, scratch, staging_path


def packed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and all other columns in one, so that no name of theirs can clash with an operator's."""
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]).alias("_row"))


def unpacked(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    return rows.select(*[changed[c].alias(c) if c in changed else F.col(c) if c in ("doc_id", "text") else F.col("_row").getField(c).alias(c) for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more by the classifier learned from ``labels`` go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    if not len(model.keep):  # nothing tells the labels apart, so nothing can be told of a document
        return docs
    return unpacked(toxicity.score_toxicity(packed(docs), model).filter(F.col("_score") < 0.5), docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least 10 documents stay where they occur first and go elsewhere; no document goes.

    Lines of two to nine documents stay, or the copies that the next stage folds would be torn to pieces first.
    """
    rows = line_dedup.dedup_lines(packed(docs), min_docs=10, min_key=1, keep_first=True)
    touched = F.col("_n_dropped") > 0
    chars = F.when(touched, F.length("_kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_row.n_chars"))
    return unpacked(rows, docs.columns, text=F.when(touched, F.col("_kept")).otherwise(F.col("text")), n_chars=chars)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word similarity 0.8 or more) stays: the one of the smallest id."""
    return unpacked(near_copies.keep_one(packed(docs)), docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return unpacked(decontaminate.find_items(packed(docs), benchmark).filter(F.size("_items") == 0), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether they decode to the text again."""
    coded = unigram.encode_documents(docs.select("doc_id", "text", "lang", "source"), unigram.default_model())
    same = F.col("_decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "lang", "source", F.size("_ids").alias("n_tokens"), F.col("_ids").alias("ids"), same.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: The learned classifier and the hashed steps have no SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = staging_path(spark, f"pipeline_{name}")
        with scratch(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
