"""Greedy near-duplicate removal in arrival order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BANDS = 4
#: Rows of a span that share a band, up to which they are compared with each other by that alone.
CROWD = 256


def signature(text: str | None) -> int:
    """Signed 64-bit fingerprint by majority over the first 8 bytes of the MD5 of character pairs; 0 for no text."""
    text = text or ""
    grams = [text[i : i + 2] for i in range(max(len(text) - 1, min(len(text), 1)))]
    if not grams:
        return 0
    raw = b"".join(hashlib.md5(g.encode(), usedforsecurity=False).digest()[:8] for g in grams)
    ones = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(grams)).view(">i8")[0])


def signatures(rows: DataFrame, text_col: str, name: str) -> DataFrame:
    """``rows`` with the fingerprint of a text column, in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([signature(t.as_py()) for t in batch.column(text_col)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.LongType())]))


def kept_apart(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut: checkpointed; a session without a checkpoint folder, such as a notebook, keeps it in memory and on disk."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.persist()


def near_pairs(rows: DataFrame, most: int = 3, horizon: int | None = None) -> DataFrame:
    """``later, earlier``: rows(seq, sig) within ``most`` differing bits and, with ``horizon``, within that many seconds of their ``at``.

    With at most 3 of 64 bits apart, one of four 16-bit bands is equal. Signatures that share a
    band and are more than ``CROWD`` are told apart by a second band too: of the three other bands at least one differs by one bit at most, so rows
    are sent to that band's value and the ones a bit away from it. Rows are multiplied on the way, so no side is broadcast by its table's size.
    """
    if most >= BANDS:
        raise ValueError("the bands find at most 3 differing bits")
    part = lambda sig, b: F.expr(f"shiftrightunsigned({sig}, CAST(16 * {b} AS INT)) & 65535")
    # rows of a horizon meet those of it and of the one before, so what recurs for years doesn't meet all its past
    span = F.lit(0).cast("long") if horizon is None else F.floor(F.col("at") / horizon)
    spans = F.array(span) if horizon is None else F.array(span, span - 1)
    named = lambda x, at: rows.select(*[F.col(c).alias(f"{x}_{c}") for c in rows.columns], at.alias("span"))
    banded = lambda d, sig: d.withColumn("band", F.explode(F.array(*map(F.lit, range(BANDS))))).withColumn("equal", part(sig, "band"))
    a, b = banded(named("a", F.explode(spans)), "a_sig"), banded(named("b", span), "b_sig")
    group = ["span", "band", "equal"]
    crowds = b.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CROWD).select(*group)
    few = a.join(crowds, group, "left_anti").join(b.join(crowds, group, "left_anti").hint("merge"), group)
    second = lambda d, sig: d.join(crowds, group, "left_semi").withColumn("other", F.explode(F.array(*map(F.lit, range(BANDS))))).filter("other <> band").withColumn("close", part(sig, "other"))
    apart = second(b, "b_sig").withColumn("close", F.explode(F.array(F.col("close"), *[F.col("close").bitwiseXOR(F.lit(1 << k).cast("long")) for k in range(16)])))
    many = second(a, "a_sig").join(apart.hint("merge"), [*group, "other", "close"]).drop("other", "close")
    met = few.unionByName(many).filter((F.col("b_seq") < F.col("a_seq")) & (F.bit_count(F.col("a_sig").bitwiseXOR(F.col("b_sig"))) <= most))
    if horizon is not None:
        met = met.filter(F.col("a_at") - F.col("b_at") <= horizon)
    return met.select(F.col("a_seq").alias("later"), F.col("b_seq").alias("earlier")).distinct()


def greedy_keep(rows: DataFrame, most: int = 3, max_rounds: int | None = None, horizon: int | None = None) -> DataFrame:
    """Rows of ``rows(seq, sig)`` that no kept earlier row resembles, as a pass in arrival order would keep them.

    With ``horizon``, only kept rows at most that many seconds older count, by a column ``at`` that rises with ``seq``.
    Without it, equal signatures are folded to their first row. Among the rest a round decides
    every row of which all earlier neighbours are decided; the rounds are as many as the longest chain of neighbours.
    Rounds go on until every row is decided; more than ``max_rounds`` of them, if given, are an error.
    """
    first = rows if horizon is not None else rows.groupBy("sig").agg(F.min("seq").alias("seq")).select("seq", "sig")
    pairs = kept_apart(near_pairs(first, most, horizon))
    state = pairs.select(F.col("later").alias("seq")).distinct().withColumn("kept", F.lit(None).cast("boolean"))
    for done in count(1):
        known = pairs.join(state.select(F.col("seq").alias("earlier"), "kept", F.lit(True).alias("in_state")), "earlier", "left")
        # rows without earlier neighbours are kept from the start
        verdict = known.withColumn("k", F.when(F.col("in_state").isNull(), True).otherwise(F.col("kept"))).groupBy(F.col("later").alias("seq")).agg(
            F.bool_or(F.coalesce("k", F.lit(False))).alias("hit"), F.bool_and(F.col("k").isNotNull()).alias("settled")
        )
        before, state = state, kept_apart(verdict.select("seq", F.when(F.col("hit"), False).when(F.col("settled"), True).alias("kept")))
        open_rows = state.filter("kept IS NULL").limit(1).count()
        before.unpersist()
        if not open_rows:
            break
        if max_rounds is not None and done >= max_rounds:
            raise RuntimeError(f"rows still undecided after {max_rounds} rounds")
    return first.join(state.filter("NOT kept").select("seq"), "seq", "left_anti")
