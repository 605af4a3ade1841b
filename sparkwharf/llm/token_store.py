"""Operator 5: token ids in Simple-8b files.

Documents are dealt out in ranges of their id and sorted inside; every task encodes its texts and
streams frames of whole documents to a file of its own in the shared folder.
The manifest of the files is an ordinary Spark table: of several attempts at a
task, only the one whose manifest row Spark commits is ever read, so a lost
executor or a retried task leaves no trace but an orphan file.

File: ``MAGIC``, then frames. Frame: the counts in ``HEAD``; int64 document ids; one
validity byte each; Simple-8b words of the documents' lengths with their block
offsets; the same of all ids; exceptions of both. All little-endian.

Cases: a null text is empty; an empty text has the end id alone; null ids sort
first; rows that share an id are ordered by text hash, then text; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkwharf.llm import simple8b
from sparkwharf.llm.common import staged, staging_path, worker_state

MAGIC = b"SWS8B\x00\x00\x01"
HEAD = "<9Q"
#: Ids after which a frame is closed.
FRAME_IDS = 1 << 20
#: Bytes of texts that are encoded together, or one text.
BLOCK_BYTES = 8 << 20
#: Trailing marks that the tokenizer splits from a word as one piece.
_MARKS = ".,;:!?#$%&*|"
#: Letters up to U+012F, and the last of some before marks.
_LETTERS = "".join(filter(str.isalpha, map(chr, range(0x130))))
_MARKED = re.compile(rf"([^ {re.escape(_MARKS)}])(?=[{re.escape(_MARKS)}])")


@cache
def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for code points from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)}


class ChunkEncoder:
    """Ids of whole texts, equal to the tokenizer's own on the whole text.

    The tokenizer turns white space to spaces and never lets a token cross one,
    so a text's ids are those of its chunks between spaces and line feeds. Arrow cuts a block of texts into chunks and numbers the
    distinct ones; those met before are looked up in a table of at most ``REMEMBERED`` chunks, others are encoded once. Chunks of plain Latin
    letters with marks behind go straight to the merges, as the tokenizer's normaliser and splitter do no more to
    them than lower-case and cut off the marks. Both shortcuts are tried on probes when a tokenizer
    is loaded; one that fits it not is not used.
    """

    PROBES = ("the", "Straße", "ÉCOLE,", "naïve!?", "don", "A", "end.", "x;:", "Größe&", "Ω", "word#$%", "Überall|*", "ﬁ", "e\u0301")
    #: Chunks of the table, and bytes of a chunk that goes there.
    REMEMBERED, LONGEST = 500_000, 64

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.words, self.ids, self.sizes = pa.array([], pa.string()), np.zeros(0, self.kind), np.zeros(0, np.int64)
        probes = pa.array(self.PROBES).filter(self._are_plain(pa.array(self.PROBES)))
        ids, sizes = self._plain(probes)
        own = [self._own(p) for p in probes.to_pylist()]
        self.plain = ids.tolist() == sum(own, []) and sizes.tolist() == [len(x) for x in own]
        whole = f"{' '.join(self.PROBES)}\n\n{'  '.join(self.PROBES)} "
        self.split = sum(map(self._own, whole.replace("\n", " ").split(" ")), []) == self._own(whole)

    def _own(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _are_plain(chunks: pa.Array) -> pa.Array:
        """Letters up to U+012F, which are composed, then marks."""
        return pc.match_substring_regex(chunks, rf"\A[{_LETTERS}]+[{re.escape(_MARKS)}]*\z")

    def _plain(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        joined = _MARKED.sub(r"\1\n", " ".join(chunks.to_pylist()).lower())  # a line feed between letters and marks
        letters = joined.encode().decode("latin-1").translate(_byte_letters() | {10: "\n", 32: " "})
        pieces = letters.replace("\n", " ").split(" ")
        number = {x: i for i, x in enumerate(dict.fromkeys(pieces))}
        at = np.fromiter(map(number.__getitem__, pieces), np.int64, len(pieces))
        tokens, ids, ends = self.tokenizer.model.tokenize, [], [0]
        for x in number:
            ids += [t.id for t in tokens(x)]
            ends.append(len(ids))
        sizes = np.diff(ends)
        first = np.append(0, np.cumsum([1 + x.count("\n") for x in letters.split(" ")])[:-1])
        return np.array(ids, self.kind)[_places(np.array(ends)[at], sizes[at])], np.add.reduceat(sizes[at], first)

    def _encoded(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks one after the other, and how many each has."""
        plain = self._are_plain(chunks).to_numpy(zero_copy_only=False) & self.plain
        ids, sizes, own = np.zeros(0, self.kind), np.zeros(len(chunks), np.int64), [self._own(c) for c in chunks.filter(pa.array(~plain)).to_pylist()]
        if plain.any():
            ids, sizes[plain] = self._plain(chunks.filter(pa.array(plain)))
        sizes[~plain] = [len(x) for x in own]
        order = np.argsort(~plain, kind="stable")  # as the ids are
        starts = np.zeros(len(chunks), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate([ids, *(np.array(x, self.kind) for x in own)])[_places(starts, sizes)], sizes

    def _known(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``ids``, and where those of each chunk start and how many they are."""
        at = pc.index_in(chunks, value_set=self.words)
        new = at.is_null().to_numpy(zero_copy_only=False)
        fresh = chunks.filter(pa.array(new))
        ids, sizes = self._encoded(fresh)
        starts, n = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        old = at.drop_null().to_numpy()
        before = np.cumsum(self.sizes) - self.sizes
        starts[~new], n[~new] = before[old], self.sizes[old]
        starts[new], n[new] = len(self.ids) + np.cumsum(sizes) - sizes, sizes
        every = np.concatenate([self.ids, ids])
        if len(self.words) + len(fresh) > self.REMEMBERED:  # only what this block had stays
            kept = np.arange(min(len(chunks), self.REMEMBERED))
            words, sizes, first = chunks.take(pa.array(kept)), n[kept], starts[kept]
            self.ids = every[_places(first, sizes)]
        else:
            words, sizes, self.ids = pa.concat_arrays([self.words, fresh]), np.concatenate([self.sizes, sizes]), every
        short = pc.less_equal(pc.binary_length(words), self.LONGEST).to_numpy(zero_copy_only=False)
        if not short.all():
            self.ids = self.ids[_places((np.cumsum(sizes) - sizes)[short], sizes[short])]
            words, sizes = words.filter(pa.array(short)), sizes[short]
        self.words, self.sizes = words, sizes
        return every, starts, n

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all texts, their numbers)``; null texts are empty."""
        texts = pc.fill_null(texts, "")
        if not self.split:
            parts = [np.array(self._own(t), self.kind) for t in texts.to_pylist()]
            return np.concatenate([np.zeros(0, self.kind), *parts]), np.array([len(p) for p in parts], np.int64)
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        numbered = cut.flatten().dictionary_encode()
        ids, starts, sizes = self._known(numbered.dictionary)
        at = numbered.indices.to_numpy()
        ends = np.append(0, np.cumsum(sizes[at]))
        return ids[_places(starts[at], sizes[at])], np.diff(ends[np.asarray(cut.offsets) - cut.offsets[0].as_py()])

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.string()))[0]


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def chunk_encoder(path: str) -> ChunkEncoder:
    return worker_state(("token chunks", path), lambda: ChunkEncoder(path))


def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``BLOCK_BYTES`` of texts."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BLOCK_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def frame(doc_ids: list[int | None], parts: list[np.ndarray]) -> bytes:
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    lens = np.array([len(p) for p in parts], np.uint64)
    lw, lo, lx = simple8b.encode(lens)
    iw, io, ix = simple8b.encode(ids)
    arrays = [
        np.array([d or 0 for d in doc_ids], "<i8"),
        np.array([d is not None for d in doc_ids], np.uint8),
        lo.astype("<u4"), lw.astype("<u8"), lx.astype("<u8"), io.astype("<u4"), iw.astype("<u8"), ix.astype("<u8"),
    ]
    head = struct.pack(HEAD, len(doc_ids), len(ids), len(lo), len(lw), len(lx), len(io), len(iw), len(ix), sum(a.nbytes for a in arrays))
    return head + b"".join(a.tobytes() for a in arrays)


def unframe(head: bytes, body: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """``(document ids, lengths, ids of all documents)``."""
    n_docs, n_ids, n_lo, n_lw, n_lx, n_io, n_iw, n_ix, _ = struct.unpack(HEAD, head)
    out, at = [], 0
    for kind, n in (("<i8", n_docs), ("u1", n_docs), ("<u4", n_lo), ("<u8", n_lw), ("<u8", n_lx), ("<u4", n_io), ("<u8", n_iw), ("<u8", n_ix)):
        out.append(np.frombuffer(body, kind, n, at))
        at += out[-1].nbytes
    docs, valid, lo, lw, lx, io, iw, ix = out
    ids = [d if v else None for d, v in zip(docs.tolist(), valid.tolist(), strict=True)]
    return ids, simple8b.decode(lw, lo, lx, n_docs).astype(np.int64), simple8b.decode(iw, io, ix, n_ids)


def write_store(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files below ``folder``; returns the staged manifest ``part, file, n_docs, n_ids, start``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, encoder = TaskContext.get(), chunk_encoder(tokenizer_path)
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        file = f"{root}/part-{context.partitionId():06d}-{context.taskAttemptId()}.s8b"
        end = np.array([end_id], encoder.kind)
        n_docs = n_ids = held = 0
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        with store.open_output_stream(file) as out:
            out.write(MAGIC)
            for batch in batches:
                for block in blocks(batch):
                    ids, lens = encoder.encode_all(block.column("text"))
                    whole = np.insert(ids, np.cumsum(lens), end)
                    ends = np.cumsum(lens + 1)
                    for doc_id, a, b in zip(block.column("id").to_pylist(), [0, *ends.tolist()], ends.tolist(), strict=False):
                        doc_ids.append(doc_id)
                        parts.append(whole[a:b])
                        held += b - a
                        if held >= FRAME_IDS:
                            out.write(frame(doc_ids, parts))
                            n_docs, n_ids, held, doc_ids, parts = n_docs + len(doc_ids), n_ids + held, 0, [], []
            if doc_ids:
                out.write(frame(doc_ids, parts))
                n_docs, n_ids = n_docs + len(doc_ids), n_ids + held
        yield pa.RecordBatch.from_pydict({"part": pa.array([context.partitionId()], pa.int32()), "file": [file], "n_docs": [n_docs], "n_ids": [n_ids]})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("tie"))
    manifest = (
        rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text").select("id", "text")
        .mapInArrow(run, "part int, file string, n_docs long, n_ids long")
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return staged(staged(manifest, "token_files").withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "token_manifest")


def read_store(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``; one frame is in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                start = row["start"]
                with store.open_input_stream(row["file"]) as src:
                    if src.read(len(MAGIC)) != MAGIC:
                        raise ValueError(f"{row['file']} is no token file")
                    while head := src.read(struct.calcsize(HEAD)):
                        docs, lens, ids = unframe(head, src.read(struct.unpack(HEAD, head)[-1]))
                        ends = np.cumsum(lens)
                        raw = memoryview(ids.astype("<u4").tobytes())
                        crcs = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lens.tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(docs, pa.int64()), pa.array(start + ends - lens), pa.array(lens), pa.array(crcs, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )
                        start += int(ends[-1])

    files = manifest.filter("n_docs > 0")
    # a row stands for a whole file, so adaptive execution must not merge these small partitions: the number is fixed
    files = files.repartitionByRange(max(1, files.count()), "part")
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_binary(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    folder = staging_path(spark, "token_store")
    return read_store(write_store(docs, tokenizer_path, 1, folder), folder)
