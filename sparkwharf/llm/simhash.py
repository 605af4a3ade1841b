"""Operator 9: SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are 64-bit majority votes over shingle hashes. For radius r,
every bit position gets a nonzero vector of r+1 bits; table v, for each nonzero v,
keeps the bits whose vector has an odd inner product with v. The vectors of r
differing bits span at most r dimensions, so some v is orthogonal to all of
them and its table keeps none of the differing bits: every pair within
the radius shares a bucket in some table, with certainty (Pagh, "Locality-
sensitive Hashing without False Negatives").

Exact copies are folded to one row per fingerprint first. Buckets of up to
``MAX_BUCKET`` fingerprints are compared inside and yield their true links only.
Fingerprints of larger buckets are linked without comparing pairs: two
fingerprints differ in at most 2 bits exactly when the balls of radius 1 around
them meet, so each is sent to its 65 ball members and linked to the smallest
fingerprint it meets there. No bucket is capped and no link is lost.

Cases: null and empty texts have fingerprint zero and are linked like others;
null ids take part but never name a component; repeated rows stay repeated;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwharf.llm.common import connected_components, free_names, join_unique, staged

BITS = 64
#: Larger buckets are linked through radius-1 balls.
MAX_BUCKET = 64
#: Shingles hashed before their bits are counted; bounds the memory of one text.
BLOCK = 65536


def simhash(text: str | None, shingle: int = 3) -> int:
    """Fingerprint of one text: ASCII lower-cased words, repeated shingles included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= shingle:
        return digest(join(words), 42)
    ones, n = np.zeros(BITS, np.int64), len(words) - shingle + 1
    for k in range(0, n, BLOCK):
        part = words[k : min(k + BLOCK, n) + shingle - 1]
        grams = zip(*(part[i:] for i in range(shingle)))
        h = np.fromiter((digest(join(g), 42) for g in grams), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id, f, fp`` per row; ``fp`` holds the 64 bits as a signed long, ``f`` tells apart texts under one id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((simhash(t.as_py(), shingle) for t in batch.column("text")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("f"), pa.array(fps.view(np.int64))], ["id", "f", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("f"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, f long, fp long")


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """The 2^(r+1) - 1 masks as signed longs; bit vectors are dealt out in turn."""
    n = 2 ** (radius + 1)
    vector = [i % (n - 1) + 1 for i in range(bits)]
    masks = (sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() % 2) for v in range(1, n))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def fingerprint_links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """True links ``a, b`` between the distinct fingerprints ``fps(fp)``; for large buckets a linking subset with the same components."""
    if radius > 2:
        raise ValueError("balls of radius 1 cover at most 2 differing bits")
    tables = F.array(*[F.struct(F.lit(t).cast("byte").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(covering_masks(radius))])
    keyed = fps.select("fp", F.explode(tables).alias("x")).select("x.t", "x.key", "fp")
    counted = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = staged(keyed.join(counted, ["t", "key"]), "simhash_buckets")
    pairs = F.expr(
        f"flatten(transform(m, (x, i) -> transform(filter(m, (y, j) -> j > i AND bit_count(x ^ y) <= {radius}), y -> struct(x AS a, y AS b))))"
    )
    cold = met.filter(F.col("n") <= MAX_BUCKET).groupBy("t", "key").agg(F.collect_list("fp").alias("m")).select(F.explode(pairs).alias("e")).select("e.*").distinct()
    flip = [1 << i for i in range(BITS - 1)] + [-(1 << 63)]
    ball = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(x)) for x in flip])
    hot = met.filter(F.col("n") > MAX_BUCKET).select("fp").distinct().select("fp", F.explode(ball).alias("z"))
    low = hot.groupBy("z").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    starred = hot.join(low, "z").filter("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    return cold.unionByName(starred)


def near_duplicates(docs: DataFrame, radius: int = 2, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, f, fp, root, component_id`` per row; ``component_id`` is the smallest id reachable by links, ``root`` the smallest fingerprint."""
    fps = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    n_rows = fps.count()
    classes = staged(fps.groupBy("fp").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")), "fingerprint_classes")
    roots = connected_components(fingerprint_links(classes.select("fp"), radius))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp")).drop("node")
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return join_unique(fps, staged(rooted.join(lows, "root").select("fp", "root", "component_id", "n"), "fingerprint_components"), "fp", n_rows)


def keep_one(docs: DataFrame, radius: int = 2, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest id, nulls last."""
    found = near_duplicates(docs, radius, shingle, id_col, text_col)
    id_, f_, own = free_names(docs, "_id", "_f", "_f0")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "f")).alias("w")).select(F.col("w.id").alias(id_), F.col("w.f").alias(f_))
    of_text = docs.withColumn(own, F.xxhash64(F.col(text_col)))
    kept = of_text.join(staged(first, "component_winners"), F.col(id_col).eqNullSafe(F.col(id_)) & (F.col(own) == F.col(f_)), "left_semi")
    return kept.dropDuplicates([id_col, own]).select(docs.columns)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = near_duplicates(docs)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
