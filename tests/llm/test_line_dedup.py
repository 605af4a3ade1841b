import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwharf.llm import line_dedup as m

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("h", T.StringType()), T.StructField("n_docs", T.StringType())])
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs, min_key, keep_first):
    key = lambda line: line.strip(m.BLANKS).translate(FOLD)
    docs, at = defaultdict(set), defaultdict(list)
    for d, t in set(rows):
        for p, line in enumerate((t or "").split("\n")):
            docs[key(line)].add(d)
            at[key(line)].append((d is not None, d or 0, t, p))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        gone = [len(key(x)) >= min_key and len(docs[key(x)]) >= min_docs and not (keep_first and min(at[key(x)]) == (d is not None, d or 0, t, p)) for p, x in enumerate(lines)]
        out.append((d, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("heavy", [1, 64])
def test_against_brute_force(spark, monkeypatch, keep_first, heavy):
    monkeypatch.setattr(m, "MIN_HEAVY_ROWS", heavy)
    texts = ["Hot Line\na\n\n  hot line\t", "É\né\nHOT LINE", "", None, "\n\n", "only", "a\nb\na", "x\x0b\n\x1cx", "hot line"]
    rows = [(i, t) for i, t in enumerate(texts * 3)] + [(3, texts[3]), (0, texts[0])]
    rows += [(None, "hot line\nnull id"), (None, None), (None, "only\nnull again")]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    got = m.dedup_lines(df, 3, 1, keep_first).select("doc_id", "_n_lines", "_n_dropped", "_kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 3, 1, keep_first)


def test_runs_are_the_bitmap(spark):
    rows = [(i, "dup\nkeep%d\ndup\ndup" % i, None, None) for i in range(4)] + [(9, "", None, None)]
    got = {r.id: list(r.runs) for r in m.keep_bitmaps(spark.createDataFrame(rows, SCHEMA), 4).collect()}
    assert got == {**{i: [0, 1, 1, 2] for i in range(4)}, 9: [1]}


def test_empty_and_long(spark):
    assert m.dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []
    long = "\n".join(f"line {i % 50000}" for i in range(60000))
    df = spark.createDataFrame([(i, long, None, None) for i in range(2)], SCHEMA)
    got = m.dedup_lines(df, 2).select(F.sha2("_kept", 256).alias("s"), "_n_dropped").collect()
    assert {tuple(r) for r in got} == {(hashlib.sha256(b"").hexdigest(), 60000)}


def test_query_over_a_folder(spark, tmp_path):
    rows = [(i, f"same\nown {i}\nSAME ") for i in range(12)] + [(50, None), (51, ""), (51, ""), (None, "same")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = m.op10_line_dedup(spark, str(tmp_path))
    want = [(d, n, g, hashlib.sha256(t.encode()).hexdigest()) for d, n, g, t in brute(rows, 10, 1, False)]
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"] and sorted(map(tuple, got.collect()), key=str) == want


def test_names_that_clash(spark):
    rows = [(i, "same\nown %d" % i, "x", "y") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id string, _f string")
    got = m.dedup_lines(df, 3)
    assert sorted((r["doc_id"], r["_id"], r["_f"], r["_kept"]) for r in got.collect()) == [(i, "x", "y", f"own {i}") for i in range(3)]
    with pytest.raises(ValueError, match="_kept"):
        m.dedup_lines(df.withColumn("_kept", F.lit(1)), 3)
