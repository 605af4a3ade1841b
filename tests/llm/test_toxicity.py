import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwharf.llm import toxicity as m

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType()), T.StructField("toxic", T.StringType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("toxic", T.IntegerType())])
PROSE = "the idiot was stupid and the clown is a worthless loser but this line is fine and that moron is pathetic trash " * 50


@pytest.fixture(scope="module")
def restorer():
    return m.Restorer(m.costs(m.trigram_counts(PROSE).reshape(28, 28, 28).astype(float)))


@pytest.mark.parametrize("hidden, word", [("1d10t", "idiot"), ("idiiiiot", "idiot"), ("$tup1d", "stupid"), ("i.d.i.o.t", "idiot"), ("cl0wn", "clown"), ("m0r0n!", "moron"), ("l-o-s-e-r", "loser"), ("tr@@@sh", "trash"), ("idiot", "idiot"), ("idiot!!", "idiot")])
def test_restores_words(restorer, hidden, word):
    assert word in restorer.word(hidden)


def test_restores_spacing(restorer):
    assert "idiot" in restorer.spaced("what an i d i o t he is".lower())
    assert restorer.spaced("a a a a a a") == [] and restorer.spaced("no such thing") == []


def test_viterbi_finds_the_cheapest_reading(restorer):
    """Against all readings, spelled out."""
    for stretch in ("1d10t", "lo5er", "a1l", "mooo0n"):
        best = [("", 0.0)]
        import re

        units = [(u[0][0], len(u[0])) for u in re.finditer(r"(.)\1*", stretch)]
        for k, (c, n) in enumerate(units):
            best = [(t + r, x + y) for t, x in best for r, y in restorer._readings(c, n, k in (0, len(units) - 1))]

        def total(item):
            a = b = 0
            cost = item[1]
            for c in item[0] + " ":
                s = restorer.symbol(c)
                cost += restorer.cost[a][b][s]
                a, b = b, s
            return cost

        assert abs(min(map(total, best)) - total((restorer.decode(stretch), min(x for t, x in best if t == restorer.decode(stretch))))) < 1e-9


def table(spark, n=400):
    rng = np.random.default_rng(3)
    calm, bad = "the line is fine and this was that but a".split(), ["idiot", "1d1ot", "i d i o t", "idiiiot"]
    rows, labels = [], []
    for i in range(n):
        words = list(rng.choice(calm, 30))
        if i % 4 == 0:
            words.insert(int(rng.integers(30)), bad[0] if i % 8 else bad[int(rng.integers(4))])
        rows.append((i, " ".join(words), None, "clash"))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark):
    rows, labels = table(spark)
    rows += [(None, None, None, None), (1000, "", None, None), (1001, "word " * 50000 + "1d10t", None, None), (5, rows[5][1], None, None)]
    labels += [(None, 1), (7, None), (8, 3), (9999, 1)]
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    got = m.score_toxicity(docs, m.train(docs, marks)).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = sum((r._score >= 0.5) == (r.doc_id % 4 == 0) for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r._score <= 1 for r in got)
    assert next(r._score for r in got if r.doc_id == 1001) > 0.5 > next(r._score for r in got if r.doc_id == 1000)


def test_no_labels_and_no_rows(spark):
    docs, none = spark.createDataFrame(table(spark, 20)[0], DOCS), spark.createDataFrame([], LABELS)
    assert [r._score for r in m.score_toxicity(docs, m.train(docs, none)).collect()] == [0.5] * 20
    empty = spark.createDataFrame([], DOCS)
    assert m.score_toxicity(empty, m.train(empty, none)).collect() == []


def test_held_out_labels_are_not_read(spark):
    rows, labels = table(spark, 120)
    docs = spark.createDataFrame(rows, DOCS)
    flip = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    marks = spark.createDataFrame(labels, LABELS)
    flipped = marks.withColumn("toxic", F.when(flip, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = m.train(docs, marks), m.train(docs, flipped)
    assert np.array_equal(a.keep, b.keep) and np.allclose(a.weights, b.weights)


def test_grams_and_pairs_of_many_words():
    """Worked out together, words have the buckets of each gram's own CRC-32, whatever their letters."""
    import random
    import zlib

    rng = random.Random(2)
    words = ["^a$", "^$", "", "^" + "x" * 70 + "$"] + ["^" + "".join(rng.choice("abcß你\U0001f600é1$") for _ in range(rng.randint(0, 12))) + "$" for _ in range(200)]
    bucket, owner = m.gram_buckets([w.encode() for w in words])
    got = sorted(zip(owner.tolist(), bucket.tolist(), strict=True))
    assert got == sorted((i, zlib.crc32(w[j : j + k].encode()) % m.BUCKETS) for i, w in enumerate(words) for k in m.GRAMS for j in range(len(w) - k + 1))
    assert m.doubled(["aabb", "", "aaa", "ab", "ab", "\U0001f600\U0001f600x"]).tolist() == [2, 0, 2, 0, 0, 1]


def test_words_together_equal_words_alone():
    import random

    rng = random.Random(3)
    cost = m.costs(m.trigram_counts("the idiot and the fool said hello to all of you " * 9).reshape(m.SYMBOLS, m.SYMBOLS, m.SYMBOLS))
    words = ["".join(rng.choice("idiotfl0!1$eéß你 .") for _ in range(rng.randint(1, 9))) for _ in range(400)] + ["hello", "iddiioot", "i.d.i.o.t", "fool!", "aaa", ""]
    for keep in (None, __import__("numpy").arange(0, m.BUCKETS, 3)):
        f = m.Features(cost, keep)
        together = f._many(words)
        assert [set(x) for x in together] == [set(f._of(w)) for w in words]
        texts = [" ".join(rng.sample(words, 30)) for _ in range(600)] + [None, ""]
        f.memo.LIMIT = 4000
        want = [set().union(*[f._of(w) for w in f._words(t)]) for t in texts]
        assert [set(x.tolist()) for x in f.texts(iter(texts))] == want
