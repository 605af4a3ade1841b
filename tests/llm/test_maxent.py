import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from sparkwharf.llm import maxent as m

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType()), T.StructField("word", T.StringType())])


def corpus(n=300):
    rng = np.random.default_rng(4)
    langs = [[f"{p}{i}{'xyz'[k]}" for i in range(60)] for k, p in enumerate(("a", "b", "c"))]
    out = []
    for d in range(n):
        words = langs[d % 3]
        p = 1 / np.arange(1, 61)
        out.append((d, " ".join(rng.choice(words, 40, p=p / p.sum())), "clash", "clash"))
    return out


def brute(rows):
    part = lambda d: None if d is None else zlib.crc32(str(d).encode()) % 7
    seen = Counter()
    for d, t, *_ in rows:
        if part(d) is not None and part(d) != 2:
            seen.update([*m.words(t), None])
    n, v = sum(seen.values()), len(seen)
    out = []
    for d, t, *_ in rows:
        tokens = [*m.words(t), None]
        out.append((d, part(d) == 2, len(tokens), sum(seen[x] > 0 for x in tokens), n, sum(math.log10((seen[x] + 1) / (n + v + 1)) for x in tokens)))
    return out


@pytest.mark.parametrize("head", [m.HEAD, 50])
def test_base_scores_and_held_out_gain(spark, head):
    rows = corpus() + [(1000, None, "", ""), (1001, "", "", ""), (None, "a1x unseen", "", ""), (5, "A1X a1x", "", ""), (1003, "a1x " * 30000, "", "")]
    got = sorted(m.score_texts(spark.createDataFrame(rows, SCHEMA), head_size=head).collect(), key=lambda r: str(r[:4]))
    want = sorted(brute(rows), key=lambda r: str(r[:4]))
    for g, w in zip(got, want, strict=True):
        assert tuple(g[:5]) == w[:5] and abs(g.base_score - w[5]) < 1e-6 * max(1, abs(w[5]))
    held = [r for r in got if r.held_out and r.id < 300]
    assert len(held) > 20 and sum(r.score for r in held) > sum(r.base_score for r in held) + 0.2 * sum(r.n_tokens for r in held)


def test_probabilities_sum_to_one():
    listed = [f"w{i}".encode() for i in range(40)]
    head, counts = m.Head(listed), np.arange(400, 0, -10)
    tail = np.zeros((m.ENDINGS, 2))
    tail[3], tail[700] = (7, 4), (2, 2)
    rng = np.random.default_rng(0)
    model = m.build_model(head, counts, 9, tail, rng.integers(0, 5, (m.FREQUENT + m.ENDINGS, m.ANCHORS)).astype(float))
    text = rng.integers(0, 41, 400).astype(np.int32)
    model.start()
    model.update(text, np.array([0, 200]))
    for history in ([5, 7], [m.HEAD + 4, 1], [2, 0]):
        total = 0.0
        for i in range(41):
            total += 10 ** model.log10(np.array([*history, i], np.int32), np.array([0]))[-1]
        for cluster in range(m.CLUSTERS):  # one unknown word and the known ones of each cluster's last class
            ids = [m.HEAD + 1 + e for e in range(m.ENDINGS) if model.cluster[m.HEAD + 1 + e] == cluster]
            if ids:
                share = 10 ** model.log10(np.array([*history, ids[0]], np.int32), np.array([0]))[-1]
                total += share * (1 + sum(tail[i - m.HEAD - 1].sum() for i in ids))
            else:
                z1, z2 = model._softmax(m.features(np.array([*history, 0], np.int32), np.array([0]))[:, 2:], np.array([cluster]))
                total += float(z1[0, cluster] * z2[0, m.MEMBERS - 1])
        assert abs(total - 1) < 1e-4


def test_rare_words_take_the_id_of_their_ending():
    head = m.Head([b"the", b"of"])
    ids, rare = head.encode(m.words("the odd of odder"))
    assert rare == [b"odd", b"odder"] and ids.tolist()[-1] == m.END and (ids[[1, 3]] > m.HEAD).all()


def test_no_training_rows_and_empty(spark):
    one = next(d for d in range(99) if zlib.crc32(str(d).encode()) % 7 == 2)
    (r,) = m.score_texts(spark.createDataFrame([(one, "a b", None, None)], SCHEMA)).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0)
    assert m.score_texts(spark.createDataFrame([], SCHEMA)).collect() == []


def test_word_order_is_learned_on_prose(spark):
    """Held-out documents of sf0.01 score above their unigram base, and above themselves with their words shuffled."""
    rng = np.random.default_rng(5)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    mixed, new = [], max(r.doc_id for r in docs) + 1
    for r in docs:
        if held(r.doc_id) and r.text and len(r.text.split()) > 20:
            while not held(new):
                new += 1
            mixed.append((new, " ".join(rng.permutation(r.text.split())), r.doc_id))
            new += 1
    rows = spark.createDataFrame([(r.doc_id, r.text) for r in docs] + [m_[:2] for m_ in mixed], "doc_id long, text string")
    got = {r.id: r for r in m.score_texts(rows).collect()}
    told = [(got[old], got[k]) for k, _, old in mixed]
    tokens = sum(r.n_tokens for r, _ in told)
    gain, order = sum(r.score - r.base_score for r, _ in told) / tokens, sum(a.score - b.score for a, b in told) / tokens
    print(f"gain {gain:.3f} and order {order:.3f} log10 a token")
    assert gain > 0.15 and order > 0.03


def test_query_over_a_folder(spark, tmp_path):
    rows = corpus(60) + [(None, "a1x", "", ""), (5, None, "", "")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = m.op6_lm_scoring(spark, str(tmp_path))
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    for g, w in zip(sorted(got.collect(), key=lambda r: str(r[:4])), sorted(brute(rows), key=lambda r: str(r[:4])), strict=True):
        assert tuple(g[:5]) == w[:5] and abs(g.base_score - w[5]) < 1e-6 * max(1, abs(w[5]))
