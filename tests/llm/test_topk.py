import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwharf.llm.topk import exact_top_k, op7_exact_topk

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.IntegerType())])


def brute(rows, step, k):
    ok = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for own, (q, qv) in enumerate(ok):
        if q % step:
            continue
        all_ = sorted(((-sum(a * b for a, b in zip(qv, v)), i) for n, (i, v) in enumerate(ok) if n != own and len(v) == len(qv)))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(all_[:k])}
    return out


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6)], 0) for i in range(240)]
    rows += [(240 + i, rows[i % 5][1], 0) for i in range(40)]  # copies and ties
    rows += [(300, None, 0), (301, [1.0, None] * 3, 0), (302, [float("nan")] * 6, 0), (303, [float("inf")] * 6, 0), (310, [], 0), (None, [1.0] * 6, 0), (320, [1.0, 2.0], 0), (321, [1.0, -2.0], 0)]
    got = exact_top_k(spark.createDataFrame(rows, SCHEMA).repartition(5), F.col("vec_id") % 10 == 0, 7).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert {tuple(r) for r in got} == brute(rows, 10, 7)


def test_few_candidates_large_components_and_none(spark):
    rows = [(0, [3e5, -2e5], 0), (1, [5e5, 1e5], 0), (2, [-5e5, 1.5e5], 0)]
    got = {tuple(r) for r in exact_top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, 10).collect()}
    assert got == {r for r in brute(rows, 1, 10) if r[0] == 0}
    assert exact_top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0, 7).collect() == []


def test_repeated_ids(spark):
    rows = [(0, [1.0, 0.0], 0), (5, [2.0, 0.0], 0), (5, [3.0, 0.0], 0), (5, [3.0, 0.0], 0), (6, [1.0, 1.0], 0)]
    got = [tuple(r) for r in exact_top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, 3).orderBy("rank").collect()]
    u = 1024 * 1024
    assert got == [(0, 1, 5, 3 * u), (0, 2, 5, 3 * u), (0, 3, 5, 2 * u)]


def test_repeated_ids_that_clear_the_cutoff_in_different_lists(spark):
    rows = [(0, [1.0, 1.0], 0), (5, [9.0, 0.0], 0), (5, [0.0, 9.0], 0), *((10 + i, [4.0, 1.0 + i / 8], 0) for i in range(5))]
    got = [tuple(r) for r in exact_top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, 3).orderBy("rank").collect()]
    assert [(r, v, s // 1024**2) for _, r, v, s in got] == [(1, 5, 9), (2, 5, 9), (3, 14, 5)]


def test_repeated_queries_are_queries_each(spark):
    rows = [(0, [1.0, 0.0], 0), (0, [0.0, 2.0], 0), (7, [3.0, 1.0], 0)]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score // 1024**2) for r in exact_top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, 1).collect())
    assert got == [(0, 1, 7, 2), (0, 1, 7, 3)]


def test_products_beyond_64_bits_fail(spark):
    for rows in ([(0, [3e13], 0), (1, [3e13], 0)], [(0, [1.0], 0), (1, [1e30], 0)]):
        with pytest.raises(Exception, match="beyond 64 bits"):
            exact_top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, 3).collect()


def test_query_over_a_folder(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i % 150, [float(x) for x in rng.normal(size=8)], i) for i in range(300)] + [(200, None, 1), (None, [1.0] * 8, 2)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = op7_exact_topk(spark, str(tmp_path))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert {tuple(r) for r in got.collect()} == brute(rows, 100, 10)
