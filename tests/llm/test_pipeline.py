import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece

import corpus_pipeline
from sparkwharf.llm import decontaminate, simhash, unigram

from .test_decontaminate import least_edits
from .test_line_dedup import brute as line_brute
from .test_simhash import components

BAD = "idiot"


@pytest.fixture(scope="module")
def sf_dir(tmp_path_factory):
    base = tmp_path_factory.mktemp("sf")
    prose = lambda k, n=60: " ".join(f"w{(k * 7919 + i * i * 31 + i * k) % 4001}" for i in range(n))
    item = prose(9999, 20)
    texts = {i: prose(i) + "\n" + prose(i + 5000, 30) for i in range(120)}
    for i in range(0, 120, 4):
        texts[i] = f"{prose(i, 30)} {BAD} {prose(i + 300)}"
    for i in range(1, 60, 4):
        texts[i] += "\nCommon footer line"
    for i in (200, 201, 202):
        texts[i] = texts[3]
    texts[203] = texts[7] + " " + item + " tail"
    texts[204], texts[205] = "", None
    docs = {"doc_id": list(texts), "text": list(texts.values()), "lang": ["en"] * len(texts), "source": ["s"] * len(texts), "n_chars": [len(t or "") for t in texts.values()]}
    pq.write_table(pa.table(docs), base / "documents.parquet")
    pq.write_table(pa.table({"doc_id": list(range(120)), "quality": [1] * 120, "toxic": pa.array([int(i % 4 == 0) for i in range(120)], pa.int32())}), base / "labels.parquet")
    pq.write_table(pa.table({"item_id": [1], "text": [item]}), base / "benchmark.parquet")
    return str(base), texts, item


def test_run_against_brute_force(spark, sf_dir):
    path, texts, item = sf_dir
    docs = {d: t for d, t in texts.items() if not t or BAD not in t}
    docs = {d: kept if dropped else docs[d] for d, _, dropped, kept in line_brute(list(docs.items()), 10, 1, True)}
    fps = sorted({simhash.simhash(t) for t in docs.values()}, key=lambda f: f - (f >> 63 << 64))
    of = dict(zip(fps, components(fps)))
    groups = {}
    for d in sorted(docs, reverse=True):
        groups[of[simhash.simhash(docs[d])]] = d
    docs = {d: docs[d] for d in groups.values()}
    docs = {d: t for d, t in docs.items() if least_edits(decontaminate.words(item), decontaminate.words(t)) > 4}
    library = sentencepiece.SentencePieceProcessor(model_proto=unigram.unigram_proto(unigram.default_model()))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect()}
    assert got.keys() == docs.keys()
    assert 203 not in got and 200 not in got and 0 not in got
    assert all(r.ids == library.encode(docs[d] or "") and r.round_trip for d, r in got.items())


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir[0]}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(30), sf_dir[0]).columns == docs.columns


def test_keep_one_with_repeated_and_null_ids(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (5, "other words than these"), (None, "alone here we are"), (None, "alone here we are")]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == [(5, "a b c d"), (5, "other words than these"), (None, "alone here we are")]


def test_odd_rows_through_the_whole_run(spark, tmp_path):
    """Null ids, repeated rows, a very long text, clashing columns, and tables without rows."""
    long = " ".join(f"w{i * i % 9973}" for i in range(40_000))
    kinds = "doc_id long, text string, lang string, source string, n_chars long, _score string, _items string, _f0 string, _kept string, _id string"
    rows = [(i, f"text number {i} of some words that differ {i * 7919} {i * 31}") for i in range(20)]
    rows += [(None, "no id has this text of seven words"), (None, "no id has this text of seven words"), (30, None), (31, ""), (32, long), (33, long), (3, rows[3][1])]
    spark.createDataFrame([(d, t, "en", "s", len(t or ""), "a", "b", "c", "d", "e") for d, t in rows], kinds).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted([*range(20), None, 30, 32], key=str)
    assert all(r.round_trip for r in got)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
