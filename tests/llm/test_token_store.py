import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from sparkwharf.llm import simple8b, token_store
from sparkwharf.llm.common import staging_path
from sparkwharf.llm.token_store import ChunkEncoder, read_store, write_store

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", None, " ", "Hello, world.", "a\tb c d\x1ce", "ÉCOLE école école İI ΣΑΣ", "it's 12,5 x-ray!!", "<|endoftext|>a <|startoftext|>",
    "word.word word...", "你好 мир \U0001f600", "ｆｕｌｌ Å Ω ﬁ", "don't", "x" * 3000, "ß ŉ ǆ", "\x00\x85 a​b﻿",
]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 1), st.integers(0, 50000), st.integers(0, 2**64 - 1)), max_size=3000))
def test_simple8b_round_trip(values):
    array = np.array(values, np.uint64)
    assert simple8b.decode(*simple8b.encode(array), len(array)).tolist() == values


def test_simple8b_packs_tightly():
    words, _, exceptions = simple8b.encode(np.zeros(1024, np.uint64))
    assert len(words) == 5 and not len(exceptions)
    words, offsets, exceptions = simple8b.encode(np.array([2**60, 7, 2**64 - 1], np.uint64))
    assert offsets.tolist() == [0, 3] and exceptions.tolist() == [2**60, 2**64 - 1]
    assert len(simple8b.encode(np.full(1000, 30000, np.uint64))[0]) == 250


def test_chunks_equal_whole_texts():
    own, plain = ChunkEncoder(PATH), Tokenizer.from_file(PATH)
    for text in [t or "" for t in TEXTS] + ["\n".join(t or "" for t in TEXTS)]:
        assert own.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_chunks_equal_any_text(text):
    assert ChunkEncoder_.encode(text).tolist() == Plain_.encode(text, add_special_tokens=False).ids


ChunkEncoder_, Plain_ = ChunkEncoder(PATH), Tokenizer.from_file(PATH)


@pytest.mark.parametrize("texts", [TEXTS, []])
def test_store_round_trip(spark, texts):
    rows = [(None if i == 3 else 7 if i in (1, 2) else 1000 - i, t, i) for i, t in enumerate(texts)]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("start", T.IntegerType())])
    folder = staging_path(spark, "test_store")
    got = read_store(write_store(spark.createDataFrame(rows, schema), PATH, 1, folder), folder).orderBy("start").collect()
    assert len(got) == len(rows)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    plain, at = Tokenizer.from_file(PATH), 0
    want = {}
    for doc_id, text, _ in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        want.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        at += r.n_tokens


def test_chunks_of_a_block_and_their_table(monkeypatch):
    """Texts of a block are encoded together; the table of chunks stays within its bound, and a chunk that it holds isn't encoded again."""
    monkeypatch.setattr(ChunkEncoder, "REMEMBERED", 12)
    own, plain = ChunkEncoder(PATH), Tokenizer.from_file(PATH)
    for texts in (TEXTS, TEXTS[::-1], ["Größe, größe Größe?! one\ntwo  three " * 3, None, "", "four five six seven eight nine ten ab cd ef gh"], TEXTS + TEXTS):
        ids, sizes = own.encode_all(pa.array(texts, pa.string()).slice(1))
        want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts[1:]]
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])
        assert len(own.words) == len(own.sizes) <= 12 and own.sizes.sum() == len(own.ids)
    seen = []
    monkeypatch.setattr(own, "_encoded", lambda chunks, encoded=own._encoded: seen.extend(chunks.to_pylist()) or encoded(chunks))
    own.encode("once more once")
    own.encode("more once")
    assert sorted(seen) == ["more", "once"]


@pytest.mark.parametrize("most, rows", [(1, [1] * 5), (10, [3, 1, 1]), (100, [5])])
def test_blocks(monkeypatch, most, rows):
    monkeypatch.setattr(token_store, "BLOCK_BYTES", most)
    batch = pa.RecordBatch.from_pydict({"id": list(range(5)), "text": pa.array(["a" * 6, "d", "b" * 3, "c" * 30, None])})
    got = list(token_store.blocks(batch))
    assert pa.Table.from_batches(got).equals(pa.Table.from_batches([batch]))
    assert [b.num_rows for b in got] == rows
