import gc
import re
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from sparkwharf.llm import collocations as m
from sparkwharf.llm import common

FOLD = {c: c + 32 for c in range(65, 91)}


def brute(rows, least, top=2000):
    f, out = defaultdict(Counter), []
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(FOLD)):
            words = re.findall(r"[^ \t]+", piece)
            for n in range(1, 5):
                f["und" if lang is None else lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    for lang, counts in f.items():
        found, n = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}, sum(a for p, a in counts.items() if len(p) == 1)
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and inside(p, q) and 100 * b >= 80 * a for q, b in found.items()):
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def rows():
    hot = [("New York is big, NEW york is old; new york", "en")] * 30
    more = [(f"to be or not to be {'very ' * (i % 4)}good\nto be! é è é è {i}", "en" if i % 3 else None) for i in range(40)]
    odd = [(None, "en"), ("", None), (None, None), ("...;;", "de"), ("a b c a b c", ""), ("x\ty  x\ty\x0bx y", "")] * 4
    return hot + more + odd + [("la la la. " * 30_000, "fr"), ("one two " * 3_000, "fr")]


SCHEMA = "text string, lang string, a int, phrase int"


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # every bound is met: parts, chunks, blocks, folding
        for name, value in (("PART", 64), ("CHUNK", 50), ("BLOCK", 64), ("MAX_BLOCK", 64), ("FILTER", 256)):
            monkeypatch.setattr(m, name, value)
    given = rows()[:-2] + [("la la la. " * 30, "fr"), ("one two " * 30, "fr")] if small else rows()
    df = spark.createDataFrame([(*r, 1, 2) for r in given], SCHEMA).repartition(3)
    assert sorted(map(tuple, m.collocations(df, least=6).collect())) == brute(given, 6)


def test_top_and_empty(spark):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows()], SCHEMA)
    assert sorted(map(tuple, m.collocations(df, least=3, top=2).collect())) == brute(rows(), 3, 2)
    assert m.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_filter_keeps_every_frequent_run(spark, monkeypatch):
    """A tiny sketch lets much through and loses nothing; a fit one lets nearly nothing else through."""
    texts = [" ".join(f"w{(i * 7 + j * j) % 3001}" for j in range(400)) for i in range(60)] + ["the same words"] * 8
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").repartition(4)
    runs = lambda width, block: {r["phrase"]: r["a"] for r in m.run_counts(df, m.heavy_filter(df, 8, width, block), width).filter("words > 0").collect()}
    true = Counter(" ".join(t.split()[i : i + n]) for t in texts for n in range(1, 5) for i in range(len(t.split()) - n + 1))
    frequent = {p: a for p, a in true.items() if a >= 8}
    few, many = runs(1 << 22, 1 << 20), runs(1 << 12, 1 << 12)
    assert frequent.items() <= few.items() <= many.items() <= true.items()
    assert len(few) < 1.02 * len(frequent) < len(many)


def test_pack():
    at = np.array([0, 1, 5, 70_000, 1 << 23])
    n = np.array([1, 30, 2, 1, 70_000])
    assert [x.tolist() for x in m.unpack(m.pack(at, n))] == [at.tolist(), n.tolist()]


def test_equal_hashes_are_told_apart():
    chunk = m.Chunk()
    chunk.add("en", b"a b a c a b")
    ids = chunk.ids()
    at = np.array([0, 2, 4])
    runs, counts = m._exact(chunk, ids, 2, at, np.zeros(3, np.uint64))
    assert {tuple(chunk.words[w] for w in r): c for r, c in zip(runs, counts, strict=True)} == {(b"a", b"b"): 2, (b"a", b"c"): 1}


def test_query_over_a_folder(spark, tmp_path):
    spark.createDataFrame(rows(), "text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = m.op13_collocations(spark, str(tmp_path))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and sorted(map(tuple, got.collect())) == brute(rows(), 30)


def test_what_a_worker_holds(spark, monkeypatch):
    """Runs become texts in small parts, in cells no more is held than a sort needs, and what another operator left in the worker goes."""
    cells = np.random.default_rng(1).integers(0, 1 << 21, 1 << 20).astype(np.uint64)
    tracemalloc.start()
    at, n = m.tally(cells)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = np.unique(cells, return_counts=True)
    assert np.array_equal(at, want[0]) and np.array_equal(n, want[1]) and held < 4 * cells.nbytes
    assert [x.tolist() for x in m.tally(cells[:0])] == [[], []]

    monkeypatch.setattr(m, "SENT", 7)
    monkeypatch.setattr(common, "_LIVE", {("other",): "a vocabulary"})
    kept = []
    texts = SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda bits: SimpleNamespace(value=bits), defaultParallelism=1)), rdd=SimpleNamespace(getNumPartitions=lambda: 1))
    texts.mapInArrow = lambda run, schema: kept.extend(run(iter([pa.RecordBatch.from_pydict({"lang": ["en"], "text": ["a b c d e f g h i j k a b"]})]))) or texts
    texts.groupBy = lambda *k: SimpleNamespace(agg=lambda c: None)
    m.run_counts(texts, [b"\xff" * 8] * 2, 64)
    assert ("other",) not in common._LIVE and max(b.num_rows for b in kept) <= 7
    assert Counter(p for b in kept for p in b.column("words").to_pylist()) == {0: 1, 1: 11, 2: 11, 3: 11, 4: 10}


def in_workers(least, width, block, bits):
    """What the tasks of both passes run."""
    found = []

    def taken(run, schema):
        found.append(run)
        raise LookupError

    texts = SimpleNamespace(mapInArrow=taken, sparkSession=SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda bits: SimpleNamespace(value=bits), defaultParallelism=1)), rdd=SimpleNamespace(getNumPartitions=lambda: 1))
    for call in (lambda: m.heavy_filter(texts, least, width, block), lambda: m.run_counts(texts, bits, width)):
        with pytest.raises(LookupError):
            call()
    return found


@pytest.mark.parametrize("step", [1, 2, 5, 1 << 16])
def test_runs_across_steps(monkeypatch, step):
    """Runs that reach into later steps count once; those of one and two words also where the chunk has none of three or four."""
    monkeypatch.setattr(m, "STEP", step, raising=False)
    _, exact = in_workers(2, 64, 64, [b"\xff" * 8] * 2)
    for texts in (["a. b! a", "b a."], ["a b a b a b a; c a b a b", "", "a b a b a"]):
        want = Counter()
        for piece in re.split("[.!;\n]", "\n".join(texts)):
            w = piece.split()
            want.update((n, " ".join(w[i : i + n])) for n in range(1, 5) for i in range(len(w) - n + 1))
        want[0, None] = sum(a for (n, _), a in want.items() if n == 1)
        got = Counter()
        for b in exact(iter([pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})])):
            for r in b.to_pylist():
                got[r["words"], r["phrase"]] += r["a"]
        assert got == want


@pytest.mark.parametrize("which", [0, 1])
def test_passes_hold_one_chunk_and_a_step(monkeypatch, which):
    """Memory of a pass by its chunk: no arrays of eight bytes for each run, and a finished chunk goes without the garbage collector."""
    monkeypatch.setattr(m, "CHUNK", 1 << 16)
    monkeypatch.setattr(m, "STEP", 1 << 12, raising=False)
    run = in_workers(30, 1 << 20, 1 << 16, [b"\xff" * (1 << 17)] * 2)[which]
    words = np.char.add("w", np.random.default_rng(2).integers(0, 10_000, (200, 1000)).astype(str))
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 200, "text": [" ".join(w) for w in words]})
    gc.collect()
    gc.disable()
    tracemalloc.start()
    try:
        for _ in run(iter([batch])):
            pass
        held = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        gc.enable()
    assert held < 125 * m.CHUNK, held / m.CHUNK
