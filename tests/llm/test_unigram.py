import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from sparkwharf.llm import unigram as m
from sparkwharf.llm.common import Memo

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=m.unigram_proto(PATH))
SF = "/root/testdata/sf0.01"
TEXTS = ["", None, " ", "  two  spaces ", "Hello, world.\nNext\n\nline", "a▁b ▁", "été ß 你好 \U0001f600\U0001f600", "tabs\tand\x0bothers ", "thththth erererer ononon", "x" * 200 + "é" * 30, "\n", "ﬁ ①"]


@pytest.mark.parametrize("text", TEXTS)
def test_against_the_library(text):
    want = LIBRARY.encode(text or "")
    assert m.encode_text(text, PATH).tolist() == want
    assert m.count_text(text, PATH) == len(want)
    assert m.decode_ids(m.encode_text(text, PATH), PATH) == (text or "").replace("▁", " ")


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text("aeinorst \n▁é你", max_size=60)))
def test_any_text_against_the_library(text):
    want = LIBRARY.encode(text)
    assert m.encode_text(text, PATH).tolist() == want
    assert m.count_text(text, PATH) == len(want)


def test_every_document_equals_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    want = {d: LIBRARY.encode(t or "") for d, t in texts.items()}
    got = {r.doc_id: r for r in m.op8_sentencepiece(spark, SF).collect()}
    assert got.keys() == want.keys() and all(got[d].ids == want[d] and got[d].n_tokens == len(want[d]) for d in want)
    assert all(r.round_trip for r in got.values())
    counts = {r.doc_id: r.n_tokens for r in m.op1_token_counts(spark, SF).collect()}
    assert counts == {d: len(x) for d, x in want.items()}
    plain = sentencepiece.SentencePieceProcessor(model_file=PATH)
    bpe = sum(len(plain.encode(t or "")) for t in texts.values())
    assert abs(sum(counts.values()) / bpe - 1) < 0.03  # as many as the file's own tokenizer, nearly


def test_streaming_commits_before_the_end():
    v = m.vocabulary(PATH)
    text = "ononerthestion" * 400
    parts = list(m.Encoder(v).stream(text))
    assert len(parts) > 20
    assert sum(parts, []) == m.Encoder(v).encode(text)
    assert sum(m.Encoder(v).stream(v.normalize(text)), []) == LIBRARY.encode(text)
    assert m.Counter(v).count(text) == sum(map(len, parts))


def test_memo_stays_within_its_bytes():
    memo = Memo(lambda s: s.encode())
    memo.LIMIT = 20_000
    for i in range(3000):
        assert memo["the"] == b"the" and memo[f"word{i}"] == f"word{i}".encode()
    assert len(memo) + len(memo.old) < 140
    long = "x" * 1000
    assert list(memo.of([long, "the"])) == [long.encode(), b"the"] and long not in memo


def test_tables(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_tokens", T.StringType())])
    rows = [(i if i != 2 else None, t, "clash") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "again")]
    df = spark.createDataFrame(rows, schema)
    assert sorted(r.n_tokens for r in m.token_counts(df, PATH).collect()) == sorted(len(LIBRARY.encode(t or "")) for _, t, _ in rows)
    got = m.encode_documents(df, PATH).collect()
    assert [(r.doc_id, r._ids, r._decoded) for r in got] == [(d, LIBRARY.encode(t or ""), (t or "").replace("▁", " ")) for d, t, _ in rows]
    empty = spark.createDataFrame([], schema)
    assert m.token_counts(empty, PATH).collect() == [] and m.encode_documents(empty, PATH).collect() == []
