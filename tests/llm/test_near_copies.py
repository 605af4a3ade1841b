import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from sparkwharf.llm import near_copies


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute(rows):
    """The ids that stay: the smallest of each component of all pairs of similarity 0.8 or more."""
    of = {d: grams(t) for d, t in rows}
    root = {d: d for d in of}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(of)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            union = of[a] | of[b]
            if not union or len(of[a] & of[b]) * 5 >= 4 * len(union):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {find(d) for d in ids}


def edited(rng, text, share):
    w = text.split()
    for _ in range(max(1, round(share * len(w)))):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    prose = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    footer, out = prose(40), {}
    for k in range(40):
        base = prose(rng.choice([6, 20, 60, 150, 400])) + (" " + footer) * (k % 2)
        out[k * 10] = base
        for j in range(1, 6):
            out[k * 10 + j] = edited(rng, base, rng.choice([0.005, 0.01, 0.02, 0.03, 0.05]))
    hot = prose(200)
    for j in range(80):
        out[1000 + j] = edited(rng, hot, 0.012)
    out |= {2000: "", 2001: None, 2002: "a b", 2003: "A  b", 2004: "b a"}
    return out


def test_every_pair_of_the_similarity_is_found(spark, texts):
    rows = list(texts.items())
    got = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    kept = brute(rows)
    assert {r.doc_id for r in got.collect()} == kept
    assert 1001 not in kept and len(kept) < len(rows) - 100


def test_pipeline_stage_drops_edited_copies(spark, tmp_path):
    rng = random.Random(5)
    rows = {}
    for k in range(20):
        rows[k] = " ".join(f"v{rng.randrange(2000)}" for _ in range(150))
        w = rows[k].split()
        for j in (20, 70, 120):
            w[j] = f"y{k}"
        rows[100 + k] = " ".join(w)
    table = {"doc_id": list(rows), "text": list(rows.values()), "lang": ["en"] * 40, "source": ["s"] * 40, "n_chars": [len(t) for t in rows.values()]}
    pq.write_table(pa.table(table), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"doc_id": [0, 1], "quality": [1, 1], "toxic": pa.array([0, 0], pa.int32())}), tmp_path / "labels.parquet")
    pq.write_table(pa.table({"item_id": [1], "text": [" ".join(f"z{i}" for i in range(20))]}), tmp_path / "benchmark.parquet")
    assert brute(list(rows.items())) == set(range(20))
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id for r in stage(spark, docs, str(tmp_path)).collect()} == set(range(20))


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (5, "other words than these"), (None, "alone here we are"), (None, "alone here we are")]
    got = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == [(5, "a b c d"), (5, "other words than these"), (None, "alone here we are")]
    assert near_copies.keep_one(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_marks_differ_in_no_more_bits_than_the_sets_in_shingles():
    rng = random.Random(5)
    for n in (0, 1, 30, 400, 3000):
        a = near_copies.shingles(" ".join(f"w{rng.randrange(900)}" for _ in range(n)))
        for share in (0.001, 0.01, 0.3, 1):
            b = near_copies.shingles(edited(rng, " ".join(f"w{rng.randrange(900)}" for _ in range(n)), share)) if n and share == 1 else a[: len(a) - int(share * len(a))]
            x, y = near_copies.marks(a), near_copies.marks(b)
            assert len(x) == near_copies.MARKS // 64
            assert sum(int(v).bit_count() for v in (x ^ y).view("<u8")) <= len(set(a.tolist()) ^ set(b.tolist()))


def test_names_that_clash(spark):
    text = "one text of a few words that is said twice in all"
    rows = [(i, text, "x", "y", "z", 1) for i in range(2)] + [(7, "another text altogether that says a thing of its own", "x", "y", "z", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id string, _f string, _f0 string, rows int")
    assert sorted(map(tuple, near_copies.keep_one(df).collect())) == [rows[0], rows[2]]
