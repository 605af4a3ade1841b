"""Operator 7: exact top-k inner products by a three-phase uniform threshold.

Every vector is cut into ``lists`` slices of its dimensions; a slice's partial inner product with a
query is that list's local score, and a candidate's score is the sum over the
lists. Following the uniform-threshold scheme for sums over distributed lists
(Cao & Wang, PODC 2004), for each block of queries:

1. every list names its k best candidates of each query; their whole scores are
   computed, and the k-th best of these is a safe cutoff t: the k-th best of all
   is at least t;
2. the cutoffs are broadcast. Centred on m_j, the mean of the query's local
   scores in list j, a sum of at least t needs some local score of at least
   m_j + (t - m) / lists, with m the sum of the means. Every list returns all
   its entries from there on, so each possible winner is collected at least once;
3. the scores of the collected candidates are resolved exactly, and the first k stay.

The queries are a stated set and are taken in blocks of ``QUERY_BLOCK``: a
block's components and cutoffs are all that is ever broadcast, so the broadcast is bounded whatever the
number of queries. Candidates are read in Arrow batches in place; only named
candidates move. Scores are integers: products go through float64 matrices where
every sum stays below 2^53, and through int64 ones up to 2^63; where a product could
reach 2^63, or a component does, the query fails with an error.

Cases: null vectors and vectors with a null, NaN or infinite component take no
part, nor do vectors of another length than the query's, nor null ids; ties go to
the smaller id; a query with fewer than k candidates gets all; every row is an entry of its
own, so rows that repeat an id are queries and candidates each, and a candidate of the other rows of
their id; no queries give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkwharf.llm.common import discard, staged

#: Queries of one pass; at 64 dimensions their components are 2 MB.
QUERY_BLOCK = 4096
#: Candidates multiplied at once inside a task.
ROWS = 512


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 1024) -> DataFrame:
    """``row, id, v`` with v = floor(scale * x) as longs, for the vectors that take part; ``row`` tells all rows apart once the result is written."""
    finite = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).filter(finite & (F.size(vec_col) > 0))
    scaled = lambda x: F.lit(float(scale)) * x.cast("double")
    whole = lambda x: F.when(F.abs(scaled(x)) < 2.0**62, F.floor(scaled(x))).otherwise(F.raise_error("a vector's component is beyond 64 bits").cast("long"))
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.transform(F.col(vec_col), whole).alias("v"))


def _matrix(column: pa.ListArray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of the batch with ``dims`` components, and their matrix."""
    lens = np.diff(column.offsets.to_numpy())
    keep = np.flatnonzero(lens == dims)
    flat = column.take(pa.array(keep)).flatten().to_numpy(zero_copy_only=False)
    return keep, flat.reshape(len(keep), dims)


def _slices(dims: int, lists: int) -> list[slice]:
    cuts = np.linspace(0, dims, lists + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]


def _product(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if most >= 2**62:
        raise OverflowError("inner products may be beyond 64 bits")
    return q @ x.T


def _best(per: DataFrame, k: int) -> DataFrame:
    """The k best ``vec_id, score`` of each ``query``; grouped limits keep at most k rows of a query in a task before the shuffle."""
    w = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return per.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _scan(spark: SparkSession, base: DataFrame, q_rows: np.ndarray, q: np.ndarray, lists: int, k: int, cut: np.ndarray | None) -> DataFrame:
    """One pass of the lists over all candidates.

    Without ``cut``: each list's k best candidates of each query within a task,
    and, without a ``row``, the sum and count of its local scores.
    With ``cut`` (queries x lists): every entry at or above it.
    Rows: ``query, list, row, vec_id, local, score`` (the whole score); ``query`` and ``row`` are row numbers.
    """
    dims, schema = q.shape[1], "query long, list int, row long, vec_id long, local double, score long"
    shared = spark.sparkContext.broadcast((q_rows, q, cut))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_q, mat, limit = shared.value
        parts = _slices(dims, lists)
        every = np.arange(len(rows_q))
        # of each list and query so far: the k best local scores with row, id and whole score, and the sum of all
        low = np.iinfo(np.int64).min
        best = [np.full((4, len(rows_q), k), low) for _ in parts]
        sums, n = np.zeros((len(parts), len(rows_q))), 0
        for batch in batches:
            keep, x_all = _matrix(batch.column("v"), dims)
            ids_all, rows_all = batch.column("id").to_numpy()[keep], batch.column("row").to_numpy()[keep]
            for at in range(0, len(keep), ROWS):
                x, ids, own = x_all[at : at + ROWS], ids_all[at : at + ROWS], rows_all[at : at + ROWS]
                local = [_product(mat[:, p], x[:, p]) for p in parts]
                total, same = sum(local), rows_q[:, None] == own[None, :]
                n += len(ids)
                for j, s in enumerate(local):
                    if limit is not None:
                        rows, cols = np.nonzero((s >= limit[:, j : j + 1]) & ~same)
                        if len(rows):
                            yield _rows(rows, j, own[cols], ids[cols], s[rows, cols], total[rows, cols], rows_q)
                        continue
                    sums[j] += s.sum(axis=1, dtype=np.float64)
                    new = np.stack([np.where(same, low, s), np.broadcast_to(own, s.shape), np.broadcast_to(ids, s.shape), total])
                    new = np.concatenate([best[j], new], axis=2)
                    top = np.argpartition(-new[0].astype(np.float64), k - 1, axis=1)[:, :k]
                    best[j] = np.take_along_axis(new, top[None], axis=2)
        if limit is None and n:
            for j, (s, own, ids, total) in enumerate(best):
                yield _rows(every, j, None, None, sums[j], np.full(len(rows_q), n), rows_q)
                rows, cols = np.nonzero(s != low)
                yield _rows(rows, j, own[rows, cols], ids[rows, cols], s[rows, cols], total[rows, cols], rows_q)

    def _rows(rows, j, own, ids, local, score, rows_q):
        names = [pa.nulls(len(rows), pa.int64()) if x is None else pa.array(x, pa.int64()) for x in (own, ids)]
        return pa.RecordBatch.from_arrays(
            [pa.array(rows_q[rows], pa.int64()), pa.array(np.full(len(rows), j, np.int32)), *names, pa.array(np.asarray(local, np.float64)), pa.array(score, pa.int64())],
            ["query", "list", "row", "vec_id", "local", "score"],
        )

    return base.mapInArrow(run, schema)


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", lists: int = 2) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest integer inner products of every query row against all other rows."""
    spark = vectors.sparkSession
    base = staged(quantised(vectors, id_col, vec_col), "topk_vectors")
    asked = vectors.filter(is_query).select(F.col(id_col).cast("long").alias("id")).distinct()
    queries = staged(base.join(asked, "id"), "topk_queries")
    blocks = queries.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(1, -(-queries.count() * 5 // (QUERY_BLOCK * 4))))))
    blocks = staged(blocks, "topk_query_blocks")
    sizes = {(r["block"], r["d"]) for r in blocks.select("block", F.size("v").alias("d")).distinct().collect()}
    found = []
    for block, dims in sorted(sizes):
        rows = blocks.filter((F.col("block") == block) & (F.size("v") == dims)).select("row", "v").toArrow()
        q_rows, q = rows.column("row").to_numpy(), _matrix(rows.column("v").combine_chunks(), dims)[1]
        named = staged(_scan(spark, base, q_rows, q, lists, k, None), "topk_lists")
        means = named.filter("row IS NULL").groupBy("query", "list").agg((F.sum("local") / F.sum("score")).alias("mean"))
        firsts = named.filter("row IS NOT NULL").dropDuplicates(["query", "row"])
        safe = _best(firsts, k).groupBy("query").agg(F.min("score").alias("t"), F.count(F.lit(1)).alias("n")).withColumn("t", F.when(F.col("n") >= k, F.col("t")))
        cut = np.full((len(q_rows), len(_slices(dims, lists))), -np.inf)
        place = {int(d): i for i, d in enumerate(q_rows)}
        mean = np.zeros_like(cut)
        for r in means.collect():  # at most QUERY_BLOCK x lists rows
            mean[place[r["query"]], r["list"]] = r["mean"]
        for r in safe.collect():  # at most QUERY_BLOCK rows
            if r["t"] is not None:
                m = mean[place[r["query"]]]
                share = (r["t"] - m.sum()) / len(m)
                # a hair lower than the bound, for the rounding of the means
                cut[place[r["query"]]] = np.floor(m + share - 1e-6 * (1 + np.abs(m) + abs(share)))
        collected = _scan(spark, base, q_rows, q, lists, k, cut).dropDuplicates(["query", "row"])  # an entry may clear several lists' cutoffs
        found.append(staged(_best(collected, k).select("query", "rank", "vec_id", "score"), "topk_found"))
        discard(named)
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.join(queries.select(F.col("row").alias("query"), F.col("id").alias("query_id")), "query").select("query_id", "rank", "vec_id", "score")


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return exact_top_k(vectors, F.col("vec_id") % 100 == 0)


OP7_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.rid AS query, q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.rid <> q.rid
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rank FROM p
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""
