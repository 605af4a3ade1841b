import random

import numpy as np
import pytest
from pyspark.sql import types as T

from sparkwharf.llm import decontaminate as m

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("item_id", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("doc_id", T.StringType())])


def least_edits(item, text):
    row = [0] * (len(text) + 1)
    for w in item:
        new = [row[0] + 1]
        for j, t in enumerate(text):
            new.append(min(row[j] + (t != w), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rng, item, n, vocabulary):
    out = list(item)
    for _ in range(n):
        k = rng.randrange(len(out))
        kind = rng.randrange(3)
        out[k : k + (kind != 1)] = [] if kind == 0 else [rng.choice(vocabulary)]
    return out


def corpus(seed, n_docs=300, n_items=30):
    rng = random.Random(seed)
    common, tail = "the of and to in a is it that for".split(), [f"w{i}" for i in range(3000)]
    word = lambda: rng.choice(common) if rng.random() < 0.4 else rng.choice(tail)
    items = [[word() for _ in range(rng.randint(15, 59))] for _ in range(n_items)]
    docs, planted = [], set()
    for d in range(n_docs):
        text = [word() for _ in range(rng.randint(0, 120))]
        if d % 2:
            i = rng.randrange(n_items)
            at = rng.randint(0, len(text))
            text[at:at] = edited(rng, items[i], rng.randint(0, int(0.2 * len(items[i]))), tail)
            planted.add((d, i))
        docs.append(text)
    return items, docs, planted


def test_recall_and_exactness_against_brute_force(spark):
    items, docs, planted = corpus(5)
    want = {(d, i): e for d, t in enumerate(docs) for i, x in enumerate(items) if (e := least_edits(x, t)) <= int(0.2 * len(x) + 1e-9)}
    assert planted <= want.keys()
    docs_df = spark.createDataFrame([(d, " ".join(t), "clash") for d, t in enumerate(docs)], DOCS)
    items_df = spark.createDataFrame([(i, " ".join(x).upper() + ".", "clash") for i, x in enumerate(items)], ITEMS)
    got = {(r.doc_id, x.item_id): x.edits for r in m.find_items(docs_df, items_df).collect() for x in r._items}
    assert got.keys() <= want.keys()
    assert len(got) >= 0.97 * len(want), len(got) / len(want)
    assert sum(got[k] == want[k] for k in got) >= 0.99 * len(got) and all(got[k] >= want[k] for k in got)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 14, 15, 16, 20, 25, 30, 31, 32, 45, 60, 64, 100])
def test_recall_at_the_threshold_itself(n):
    rng, vocabulary, common = random.Random(9), [f"w{i}" for i in range(3000)], "the of and to in a is it".split()
    word = lambda: rng.choice(common) if rng.random() < 0.4 else rng.choice(vocabulary)
    items = [[word() for _ in range(n)] for _ in range(200)]
    index = m.Index([(i, [w.encode() for w in x]) for i, x in enumerate(items)], 0.8)
    texts = [[word() for _ in range(20)] + edited(rng, x, int(0.2 * n + 1e-9), vocabulary) + [word() for _ in range(20)] for x in items]
    found = {(t, i) for t, i, _, _ in index.search([np.array([index.vocabulary.get(w.encode(), 0) for w in t], np.int32) for t in texts])}
    share = sum((i, i) in found for i in range(200)) / 200
    assert share == 1 if n < m.WALKED else share >= 0.95


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(m, "GROUP_WORDS", 10)
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    items = [(3, item, None), (2, item.upper() + "!", None), (None, "one two three four five six", None), (7, "too short", None), (8, None, None), (9, "", None)]
    docs = [(1, f"x {item} y", None), (1, f"x {item} y", None), (2, None, None), (3, "", None), (None, item, None), (5, "z " * 40000 + item, None), (6, "one two three four five six", None), (7, "too short", None)]
    got = m.find_items(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert [[(x.item_id, x.edits) for x in r._items] for r in got] == [[(2, 0)], [(2, 0)], [], [], [(2, 0)], [(2, 0)], [(None, 0)], [(7, 0)]]
    none = spark.createDataFrame([], ITEMS)
    assert all(r._items == [] for r in m.find_items(spark.createDataFrame(docs, DOCS), none).collect())
    assert m.find_items(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)).collect() == []


def test_query_over_a_folder(spark, tmp_path):
    items, docs, planted = corpus(11, 80, 10)
    spark.createDataFrame([(d, " ".join(t), None) for d, t in enumerate(docs)] + [(900, None, None), (None, "", None)], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, " ".join(x), None) for i, x in enumerate(items)] + [(99, None, None)], ITEMS).write.parquet(str(tmp_path / "benchmark.parquet"))
    got = m.op4_benchmark_decontamination(spark, str(tmp_path))
    assert got.columns == ["doc_id", "item_id", "edit_distance"]
    want = {(d, i, e) for d, t in enumerate(docs) for i, x in enumerate(items) if (e := least_edits(x, t)) <= int(0.2 * len(x) + 1e-9)}
    rows = {tuple(r) for r in got.collect()}
    assert planted <= {r[:2] for r in rows} and rows <= want and len(rows) >= 0.97 * len(want)
