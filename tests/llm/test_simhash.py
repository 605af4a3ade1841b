import random

import pytest
import xxhash
from pyspark.sql import types as T

from sparkwharf.llm import simhash as m

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("fp", T.StringType())])


def slow(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("text", ["", None, "a", "A b", "the THE the", "x " * 500, "a\tb\x0bc d e É é", "\x1c \x85 z"])
def test_fingerprint(text):
    assert m.simhash(text) == slow(text)


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(str(i * i % 97) for i in range(1000))
    monkeypatch.setattr(m, "BLOCK", 64)
    assert m.simhash(text) == slow(text)


def test_masks_cover_every_pair_within_the_radius():
    for r in (1, 2):
        masks = [x % 2**64 for x in m.covering_masks(r)]
        bits = [[i] for i in range(64)] + ([[i, j] for i in range(64) for j in range(i)] if r == 2 else [])
        for b in bits:
            diff = sum(1 << i for i in b)
            assert any(not diff & x for x in masks)


def components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("bucket", [64, 3])
def test_links_have_the_components_of_all_pairs(spark, monkeypatch, bucket):
    monkeypatch.setattr(m, "MAX_BUCKET", bucket)
    rng = random.Random(bucket)
    fps = []
    for _ in range(30):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 30])):
            fps.append(x)
            for _ in range(rng.choice([0, 1, 2, 3])):
                x ^= 1 << rng.randrange(64)
    fps = sorted(set(fps), key=lambda f: f - (f >> 63 << 64))
    df = spark.createDataFrame([(f - (f >> 63 << 64),) for f in fps], "fp long")
    found = {r.node: r.root for r in m.connected_components(m.fingerprint_links(df)).collect()}
    signed = [f - (f >> 63 << 64) for f in fps]
    assert [found.get(f, f) for f in signed] == [signed[r] for r in components(fps)]


def test_near_duplicates(spark):
    base = " ".join(f"w{i}" for i in range(400))
    texts = [base, base + " x", base.upper(), None, "", "other words here now", base, "a"]
    rows = [(10 - i, t, "clash") for i, t in enumerate(texts)] + [(None, base, "c"), (10, base, "c")]
    got = m.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    fps = sorted({slow(t) for _, t, _ in rows}, key=lambda f: f - (f >> 63 << 64))
    comp = dict(zip(fps, components(fps)))
    for r in got:
        mine = [d for d, t, _ in rows if comp[slow(t)] == comp[r.fp % 2**64] and d is not None]
        assert r.component_id == min(mine)
    assert m.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_names_that_clash(spark):
    rows = [(i, "one text that is said twice", "x", "y", "z") for i in range(2)] + [(7, "another text altogether here", "x", "y", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id string, _f string, _f0 string")
    assert sorted(map(tuple, m.keep_one(df).collect())) == [rows[0], rows[2]]
