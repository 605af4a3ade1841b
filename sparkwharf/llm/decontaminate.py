"""Operator 4: benchmark passages in documents, by CGK embedding and bit sampling.

Texts are sequences of words. The CGK embedding walks over a sequence with random bits
that depend on step and word: each step writes the present word and stays or
moves on. Sequences within a small edit distance share a walk with few differing
steps (Chakraborty, Goldenberg & Koucky, STOC 2016), so edit distance becomes
Hamming distance. A repetition draws a walk and a sample of its steps as a key, both anew. Items are
dealt out in classes of doubling length; the samples of a class reach over windows
from a few words to the size of its items. Walks start at every word of an item
and of the stretches of text that can hold one. Equal keys propose an
item at an alignment; with ``REPETITIONS`` walks the share of passages that are
proposed reaches the target recall, which the tests measure at the
threshold itself for items of 1 to 60 words. Every proposal is checked by the exact edit distance between
the item and the nearest stretch of the text.

A document holds an item if some stretch of its words is within
floor((1 - similarity) * n) word edits of the item's n words. Words are
lower-case and without ASCII punctuation. Two conditions that every match meets are tried first: a match of n
words and k edits keeps n - 1 - 2k of the item's pairs of adjacent words, and n - k of its words. Items of fewer than
``WALKED`` words are too short for a walk; they are cut into k + 1 pieces, one of which
every match holds unchanged, so for them the search is exact.

The index is built by tasks in groups of about ``GROUP_WORDS`` words and written to files in the shared
folder; one pass over the documents, which stay in place and are never shuffled, loads one group at a time.

Cases: null and empty texts hold nothing; items without words never match; items with equal words are one, under
the smallest id, nulls last; repeated documents are each searched; an empty table or benchmark gives no matches;
other columns are carried.
"""

from __future__ import annotations

import pickle
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwharf.llm.common import staged, staging_path, with_fields, worker_state

#: Items of fewer words are compared by pieces.
WALKED = 8
#: Walks of a class of lengths, and sampled steps of a walk; a walk's last step at most.
REPETITIONS, SAMPLED, LAST = 24, 5, 126
GROUP_WORDS = 100_000
#: Words of text embedded at once, and cells of edit tables computed at once.
BLOCK_WORDS, CELLS = 1 << 18, 1 << 22
_TABLE = 1 << 21
_MULTIPLY = np.int64(1_000_003)
_MARKS = string.punctuation.encode()


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(None, _MARKS).split()


def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.int64(2_654_435_761) + b
    return (x ^ (x >> 15)) & (_TABLE - 1)


class Keys:
    """Sorted keys with the item and the word of it where each begins."""

    def __init__(self, key: np.ndarray, owner: np.ndarray, offset: np.ndarray):
        order = np.argsort(key, kind="stable")
        self.key, self.owner, self.offset = key[order], owner[order].astype(np.int32), offset[order].astype(np.int32)

    def meet(self, pos: np.ndarray, key: np.ndarray) -> np.ndarray:
        """(place, alignment, item) of every equal key."""
        low = np.searchsorted(self.key, key)
        hit = low < len(self.key)
        hit[hit] = self.key[low[hit]] == key[hit]
        pos, key, low = pos[hit], key[hit], low[hit]
        n = np.searchsorted(self.key, key, side="right") - low
        row = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
        place = np.repeat(pos, n)
        return np.stack([place, place - self.offset[row], self.owner[row].astype(np.int64)])


class Walks:
    """The walks over the items of one class of lengths."""

    def __init__(self, members: np.ndarray, lens: np.ndarray, edits: np.ndarray, shortest: int, words_: int, flat: np.ndarray, at: np.ndarray, owner: np.ndarray, offset: np.ndarray, repetitions: int):
        self.pairs, self.window = int((lens - 1 - 2 * edits)[members].min()), int((lens + edits)[members].max())
        mine = np.isin(owner, members)
        at, owner, offset = at[mine], owner[mine], offset[mine]
        self.pair = np.zeros(_TABLE, bool)
        inner = at[flat[at + 1] < words_]
        self.pair[_slot(flat[inner].astype(np.int64), flat[inner + 1])] = True
        rng = np.random.default_rng(shortest)
        # two words of random bits for each walk and word; the sign that ends a text holds a walk for good
        self.bits = rng.integers(0, 1 << 63, (repetitions, 2, words_ + 1), np.int64)
        self.bits[:, :, words_] = 0
        spans = np.unique(np.linspace(7, min(2 * shortest - 4, LAST), repetitions).astype(int), return_inverse=True)
        spans = spans[0][spans[1]]
        self.steps = [np.concatenate([[0], np.sort(rng.choice(np.arange(1, s + 1), SAMPLED - 1, replace=False))]) for s in spans]
        back = np.zeros(len(flat), np.int64)
        back[at] = np.arange(len(at))
        self.keys = []
        for r in range(repetitions):
            pos, key = self.walk(flat, at, r, words_)
            self.keys.append(Keys(key, owner[back[pos]], offset[back[pos]]))

    def walk(self, flat: np.ndarray, at: np.ndarray, r: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Walk r from every place in ``at``: the places whose sampled words are all known, and their keys."""
        now, key, steps = at, np.zeros(len(at), np.int64), set(self.steps[r].tolist())
        for step in range(max(steps) + 1):
            word = flat[now]
            if step in steps:
                known = (word > 0) & (word < stop)
                at, now, key, word = at[known], now[known], key[known], word[known]
                key = key * _MULTIPLY + word
            now = now + ((self.bits[r, step // 63, word] >> (step % 63)) & 1)
        return at, key

    def reach(self, flat: np.ndarray, stop: int) -> np.ndarray:
        """The places of known words that a match may cover: those in a window with enough of the class's pairs."""
        known = (flat > 0) & (flat < stop)
        if self.pairs <= 0 or len(flat) < 2:
            return np.flatnonzero(known)
        met = np.zeros(len(flat) + 1, np.int32)
        both = known[:-1] & known[1:]
        place = np.flatnonzero(both)
        met[place + 1] = self.pair[_slot(flat[place].astype(np.int64), flat[place + 1])]
        total = np.cumsum(met, out=met)
        ends = np.minimum(np.arange(len(flat)) + self.window, len(flat))
        good = np.flatnonzero(total[ends] - total[:-1] >= self.pairs)
        cover = np.zeros(len(flat) + 1, np.int32)
        cover[good] += 1
        np.subtract.at(cover, ends[good], 1)
        return np.flatnonzero((np.cumsum(cover[:-1]) > 0) & known)

    def search(self, flat: np.ndarray, stop: int) -> list[np.ndarray]:
        at = self.reach(flat, stop)
        return [keys.meet(*self.walk(flat, at, r, stop)) for r, keys in enumerate(self.keys)] if len(at) else []


class Pieces:
    """The items of fewer than WALKED words, by pieces of consecutive words."""

    def __init__(self, members: np.ndarray, items: list[np.ndarray], edits: np.ndarray):
        rows: dict[int, list[tuple[int, int, int]]] = {}
        for i in members.tolist():
            cuts = np.linspace(0, len(items[i]), int(edits[i]) + 2).astype(int)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                key = np.zeros(1, np.int64)  # an array, whose products wrap around as the texts' do
                for w in items[i][a:b]:
                    key = key * _MULTIPLY + w
                rows.setdefault(int(b - a), []).append((int(key[0]), i, int(a)))
        self.keys = {n: Keys(*np.array(r, np.int64).T) for n, r in rows.items()}

    def search(self, flat: np.ndarray, stop: int) -> list[np.ndarray]:
        at = np.flatnonzero((flat > 0) & (flat < stop))
        key, found = np.zeros(len(at), np.int64), []
        for n in range(1, max(self.keys) + 1):
            word = flat[np.minimum(at + n - 1, len(flat) - 1)]
            known = (word > 0) & (word < stop)
            at, key = at[known], key[known] * _MULTIPLY + word[known]
            if n in self.keys:
                found.append(self.keys[n].meet(at, key))
        return found


class Index:
    """The keys of one group of items."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], similarity: float, repetitions: int = REPETITIONS):
        self.ids = [i for i, _ in items]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for _, ws in items for w in ws}), 1)}
        self.stop = len(self.vocabulary) + 1
        self.items = [np.array([self.vocabulary[w] for w in ws], np.int32) for _, ws in items]
        self.lens = np.array([len(x) for x in self.items], np.int64)
        self.edits = ((1 - similarity) * self.lens + 1e-9).astype(np.int64)
        flat, starts = self.lay_out(self.items)
        owner = np.repeat(np.arange(len(items)), self.lens)
        offset = np.concatenate([np.arange(n) for n in self.lens]) if items else np.zeros(0, np.int64)
        at = np.repeat(starts, self.lens) + offset
        self.has = np.zeros(_TABLE, bool)  # a superset, by hash, of the words of each item
        self.has[_slot(owner, flat[at])] = True
        self.parts: list[Walks | Pieces] = []
        short = np.flatnonzero(self.lens < WALKED)
        if len(short):
            self.parts.append(Pieces(short, self.items, self.edits))
        low = WALKED
        while low <= self.lens.max(initial=0):
            members = np.flatnonzero((self.lens >= low) & (self.lens < 2 * low))
            if len(members):
                # longer items have more words to begin at, so fewer walks do
                self.parts.append(Walks(members, self.lens, self.edits, low, self.stop, flat, at, owner, offset, max(8, repetitions * WALKED // low)))
            low *= 2

    def lay_out(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """All texts in one array, each with a stop sign behind; and their starts."""
        lens = np.array([len(t) for t in texts], np.int64)
        starts = np.concatenate([[0], np.cumsum(lens + 1)[:-1]]).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
        flat = np.full(int((lens + 1).sum()), self.stop, np.int32)
        for s, t in zip(starts.tolist(), texts, strict=True):
            flat[s : s + len(t)] = t
        return flat, starts

    def search(self, texts: list[np.ndarray]) -> list[tuple[int, int, int, int]]:
        """``(text, item, edits, first word near the match)`` of every text that holds an item."""
        flat, starts = self.lay_out(texts)
        found = [x for part in self.parts for x in part.search(flat, self.stop)]
        at, place, item = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        if not len(at):
            return []
        text = np.searchsorted(starts, at, side="right") - 1
        ends = np.append(starts[1:], len(flat)) - 1
        # alignments within a few words of each other are checked once
        cell = 16
        once = np.unique(np.stack([text, item, place // cell]), axis=1)
        text, item, place = once[0], once[1], once[2] * cell
        low = np.maximum(place - self.edits[item], starts[text])
        high = np.minimum(place + cell + self.lens[item] + self.edits[item], ends[text])
        enough = np.concatenate([self._enough_words(flat, low[k : k + 8192], high[k : k + 8192], item[k : k + 8192]) for k in range(0, len(item), 8192)])
        text, item, low, high = text[enough], item[enough], low[enough], high[enough]
        order = np.argsort(high - low, kind="stable")  # windows of like width share an edit table
        text, item, low, high = text[order], item[order], low[order], high[order]
        best: dict[tuple[int, int], tuple[int, int]] = {}
        done = 0
        while done < len(item):
            step = max(1, min(4096, CELLS // int(high[min(done + 4095, len(item) - 1)] - low[min(done + 4095, len(item) - 1)] + 1)))
            part = slice(done, done + step)
            done += step
            edits = self.verify(flat, low[part], high[part], item[part])
            for t, i, e, a in zip(text[part].tolist(), item[part].tolist(), edits.tolist(), low[part].tolist(), strict=True):
                if e <= self.edits[i] and ((t, i) not in best or (e, a) < best[t, i]):
                    best[t, i] = e, a
        return [(t, i, e, a - int(starts[t])) for (t, i), (e, a) in sorted(best.items())]

    def _enough_words(self, flat: np.ndarray, low: np.ndarray, high: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Whether flat[low:high] has as many words of the item as a match must share with it; never false for a match."""
        lens = np.maximum(high - low, 0)
        ends = np.cumsum(lens)
        row = np.repeat(np.arange(len(low)), lens)
        word = flat[np.arange(int(ends[-1]) if len(ends) else 0) - (ends - lens)[row] + low[row]]
        hit = self.has[_slot(item[row], word)] & (word > 0)
        return np.bincount(row, weights=hit, minlength=len(low)) >= (self.lens - self.edits)[item]

    def verify(self, flat: np.ndarray, low: np.ndarray, high: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Least edits between each item and any stretch of flat[low:high]; all pairs advance together."""
        width = int((high - low).max(initial=0))
        cols = np.arange(width)
        region = flat[np.minimum(low[:, None] + cols, len(flat) - 1)]
        region[cols[None, :] >= (high - low)[:, None]] = 0
        lens = self.lens[item]
        padded = np.zeros((len(item), int(lens.max(initial=0))), np.int32)
        for k, i in enumerate(item):
            padded[k, : lens[k]] = self.items[i]
        steps = np.arange(width + 1, dtype=np.int32)
        row = np.zeros((len(item), width + 1), np.int32)  # a match may begin anywhere
        for i in range(padded.shape[1]):
            new = row + 1
            np.minimum(new[:, 1:], row[:, :-1] + (region != padded[:, i : i + 1]), out=new[:, 1:])
            new = np.minimum.accumulate(new - steps, axis=1) + steps
            row = np.where((i < lens)[:, None], new, row)
        return row.min(axis=1)  # and end anywhere


def build_index(benchmark: DataFrame, similarity: float, repetitions: int, item_id: str, item_text: str) -> tuple[str, list[str]]:
    """The shared folder and the files of the groups' indexes; items are folded by their words and indexed by tasks."""
    spark = benchmark.sparkSession
    folder = staging_path(spark, "benchmark_index")

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [words(t.as_py()) for t in batch.column("t")]
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array([b" ".join(ws) for ws in lists], pa.binary()), pa.array([len(ws) for ws in lists], pa.int64())], ["i", "words", "n"])

    rows = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).mapInArrow(folded, "i long, words binary, n long")
    items = staged(rows.filter("n > 0").groupBy("words").agg(F.min("i").alias("i"), F.first("n").alias("n")), "benchmark_items")
    total = items.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def build(group: pa.Table) -> pa.Table:
        context = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        listed = sorted(zip(group.column("i").to_pylist(), group.column("words").to_pylist(), strict=True), key=lambda x: (x[0] is None, x[0], x[1]))
        file = f"{root}/index-{group.column('g')[0].as_py():06d}-{context.taskAttemptId()}"
        with store.open_output_stream(file) as out:
            out.write(pickle.dumps(Index([(i, ws.split()) for i, ws in listed], similarity, repetitions), protocol=5))
        return pa.table({"file": [file]})

    # groups are dealt by hash, so their number and size are the same however many tasks there are; only the files of committed tasks are named in the staged table
    group = F.pmod(F.xxhash64("words"), F.lit(max(1, -(-total // GROUP_WORDS)))).alias("g")
    made = items.select("i", "words", group).groupBy("g").applyInArrow(build, "file string")
    return folder, sorted(r["file"] for r in staged(made, "benchmark_files").collect())  # one for GROUP_WORDS words


def load_index(store: fs.FileSystem, file: str) -> Index:
    """The index in a file; a worker keeps the last."""

    def load() -> Index:
        with store.open_input_stream(file) as src:
            return pickle.loads(src.read())

    return worker_state(("index", file), load)


def find_items(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, repetitions: int = REPETITIONS, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with ``_items`` added: the items each document holds, as array<struct<item_id, edits, near>>."""
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("near", pa.int32())]))
    folder, files = build_index(benchmark, similarity, repetitions, item_id, item_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            held: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            texts, n, column = [], 0, batch.column(text_col)
            for k in range(batch.num_rows if files else 0):
                texts.append(words(column[k].as_py()))
                n += len(texts[-1])
                if n < BLOCK_WORDS and k < batch.num_rows - 1:
                    continue
                first = k + 1 - len(texts)
                for file in files:
                    index = load_index(store, file)
                    known = index.vocabulary.get
                    for t, i, e, a in index.search([np.array([known(w, 0) for w in ws], np.int32) for ws in texts]):
                        held[first + t].append({"item_id": index.ids[i], "edits": e, "near": a})
                texts, n = [], 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(held, kind)], [*batch.schema.names, "_items"])

    return docs.mapInArrow(run, with_fields(docs, _items="array<struct<item_id:bigint,edits:int,near:int>>"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = find_items(docs, benchmark).select("doc_id", F.explode("_items").alias("m"))
    return found.select("doc_id", F.col("m.item_id").alias("item_id"), F.col("m.edits").alias("edit_distance"))
