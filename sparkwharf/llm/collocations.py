r"""Operator 13: phrases mined through merged count-min sketches.

Texts are cut at ``[.,;:!?\x0A-\x0D]`` and their pieces into words; all runs of one to ``MAX_WORDS`` words of a piece are counted by
language. Nearly all of them are rare, so they are never sent anywhere by name:

1. each task adds the hashes of its runs to a count-min sketch of two rows and emits the cells that it met, packed block by block;
   the blocks of all tasks are merged by adding them up. A cell's sum is never below the count of any run in it. Cells of
   ``least`` or more become bits of a filter. The sketch has a cell in each row for about ``LOAD`` runs of the corpus, so it grows with
   the input, but no task holds more of it than one block. The filter is folded to at most ``FILTER`` bits a row, and it is all
   that is broadcast; folding lets more runs through and loses none.
2. the texts are read again. Runs whose bits are set in both rows are counted exactly, by the words themselves, and those
   of ``least`` or more kept.

Every part of a frequent run is as frequent as it, so the kept runs hold all counts that the scores ask for. Scores and
subsumption are joins and grouped extremes.

A task numbers the words of a chunk, hashes runs from the words' hashes, and compares equal hashes word by word, so no two runs
are ever mixed up in the exact count.

Cases: null text is empty; a null language is ``und``, an empty one is a language of its own; empty texts and pieces have no
words; very long texts are worked on in parts of about ``PART`` bytes that end where a piece does; rows that repeat count each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkwharf.llm.common import staged, worker_state

MAX_WORDS = 4
#: A word, or signs that end a piece.
TOKEN = re.compile(rb"[.,;:!?\n-\r]+|[^ \t.,;:!?\n-\r]+")
END = re.compile(rb"[.,;:!?\n-\r]")
ENDS = frozenset(b".,;:!?\n\x0b\x0c\r")
#: Words of one chunk, different words after which it ends earlier, bytes of a part of a text.
CHUNK, VOCABULARY, PART = 1 << 20, 1 << 18, 1 << 22
#: Runs of the corpus for each cell of a sketch row; cells of a block, at least and at most; bits of one row of the filter.
LOAD, BLOCK, MAX_BLOCK, FILTER = 16, 1 << 20, 1 << 24, 1 << 28
#: Places of a chunk that are worked on at once, runs that become texts and are sent at once.
STEP, SENT = 1 << 16, 1 << 15
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class Words(dict):
    """Numbers of the words of one language within a chunk; 0 ends a piece. Doesn't refer to the chunk, or only the garbage collector would end it."""

    def __init__(self, lang: str, chunk: Chunk):
        super().__init__()
        self.lang, self.seed = lang, xxhash.xxh3_64_intdigest(lang.encode())
        self.words, self.langs, self.hashes = chunk.words, chunk.langs, chunk.hashes

    def __missing__(self, token: bytes) -> int:
        if token[0] in ENDS:
            return 0
        self[token] = n = len(self.words)
        self.words.append(token)
        self.langs.append(self.lang)
        self.hashes.append(xxhash.xxh3_64_intdigest(token, self.seed))
        return n


class Chunk:
    """Some texts as numbers of words."""

    def __init__(self):
        self.words, self.langs, self.hashes, self.by_lang, self.numbers, self.n = [b""], [""], array("Q", [0]), {}, array("i"), 0

    def add(self, lang: str, text: bytes) -> None:
        words = self.by_lang.get(lang) or self.by_lang.setdefault(lang, Words(lang, self))
        tokens = TOKEN.findall(text)
        self.numbers.extend(map(words.__getitem__, tokens))
        self.numbers.append(0)
        self.n += len(tokens)

    @property
    def full(self) -> bool:
        return self.n >= CHUNK or len(self.words) >= VOCABULARY

    def ids(self) -> np.ndarray:
        return np.frombuffer(self.numbers, np.int32)

    def runs(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``words, starts, hashes`` of all runs, by their number of words for every ``STEP`` starts."""
        hashes = np.frombuffer(self.hashes, np.uint64)
        for first in range(0, len(ids), STEP):
            some = ids[first : first + STEP + MAX_WORDS - 1]
            one = h = hashes[some]
            inside = alive = some > 0
            for n in range(1, MAX_WORDS + 1):
                if n > 1:
                    h = h[:-1] * _M1 + one[n - 1 :]
                    h ^= h >> np.uint64(29)
                    h *= _M2
                    h ^= h >> np.uint64(32)
                    alive = alive[:-1] & inside[n - 1 :]
                at = np.flatnonzero(alive[:STEP])
                if not len(at):
                    break
                yield n, (at + first).astype(np.int32), h[at]


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    chunk = Chunk()
    for batch in batches:
        for lang, value in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
            text = value.as_py().lower()  # of bytes: only A-Z change
            at = 0
            while at < len(text):
                end = END.search(text, at + PART) if len(text) > at + PART else None
                end = end.end() if end else len(text)
                chunk.add(lang, text[at:end])
                at = end
                if chunk.full:
                    yield chunk
                    chunk = Chunk()
    if chunk.n:
        yield chunk


def cells(hashes: np.ndarray, row: int, width: int) -> np.ndarray:
    """The cell of each hash in a row of the sketch; ``width`` is a power of two."""
    if row:
        hashes = hashes * _M3
        hashes ^= hashes >> np.uint64(31)
    return hashes & np.uint64(width - 1)


def _planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def pack(offsets: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending offsets and their counts, 32 bits each."""
    return zstandard.compress(_planes(np.diff(offsets, prepend=0)) + _planes(counts), 1)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(2, 4, -1)
    steps, counts = (np.ascontiguousarray(p.T).view("<u4").ravel() for p in planes)
    return np.cumsum(steps, dtype=np.int64), counts


def tally(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cells that occur, ascending, and how often each does; sorts them in place."""
    cells.sort()
    first = np.flatnonzero(np.append(True, cells[1:] != cells[:-1])[: len(cells)])
    return cells[first].astype(np.int64), np.diff(np.append(first, len(cells)))


def sketch_shape(n_runs: int) -> tuple[int, int]:
    """Cells of a row, and of a block of it: powers of two."""
    width = max(BLOCK, 1 << max(0, n_runs // LOAD - 1).bit_length())
    return width, min(width, MAX_BLOCK, max(BLOCK, width >> 13))


def heavy_filter(texts: DataFrame, least: int, width: int, block: int) -> list[bytes]:
    """For each row of the merged sketch the bits of its cells of ``least`` or more, folded to at most ``FILTER``."""
    folded, kind = min(width, FILTER), np.uint32 if width <= 1 << 32 else np.uint64
    starts = np.arange(1, width // block, dtype=kind) * kind(block)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state(("collocations",), dict)  # what another operator left in this worker goes
        for chunk in chunks(batches):
            ids = chunk.ids()
            for row in (0, 1):  # hashing again is cheaper than holding the hashes
                met, n = np.empty(MAX_WORDS * len(ids), kind), 0
                for _, _, h in chunk.runs(ids):
                    met[n : n + len(h)] = cells(h, row, width)
                    n += len(h)
                met = met[:n]
                met.sort()
                places, blocks, data = [], [], []
                for b, some in enumerate(np.split(met, np.searchsorted(met, starts))):
                    if len(some):
                        at, count = tally(some)
                        places.append((b * block) % folded)
                        blocks.append(b)
                        data.append(pack(at - b * block, np.minimum(count, least)))
                if data:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(data), row, np.int32)), pa.array(places, pa.int64()), pa.array(blocks, pa.int64()), pa.array(data, pa.binary())], ["row", "place", "block", "data"])
            del chunk, ids, met, some  # before the next chunk is made

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks arrive in order of their place in the filter; only one is held."""
        now, sums, bits = None, np.zeros(block, np.uint64), np.zeros(block, bool)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"row": pa.array([now[0]], pa.int32()), "place": [now[1]], "bits": [zstandard.compress(np.packbits(bits, bitorder="little").tobytes(), 1)]})

        for batch in batches:
            for row, place, at, data in zip(*(batch.column(c).to_pylist() for c in ("row", "place", "block")), batch.column("data"), strict=True):
                if now != (row, place, at):
                    if now:
                        bits |= sums >= least
                        if now[:2] != (row, place):
                            yield done()
                            bits[:] = False
                    sums[:], now = 0, (row, place, at)
                offsets, n = unpack(data.as_py())
                sums[offsets] += n
        if now:
            bits |= sums >= least
            yield done()

    key = ["row", "place"]
    parts = texts.mapInArrow(sketch, "row int, place long, block long, data binary").repartition(*key).sortWithinPartitions(*key, "block")
    found = [np.zeros(folded // 8, np.uint8) for _ in range(2)]
    for r in parts.mapInArrow(merge, "row int, place long, bits binary").toLocalIterator():  # 2 x FILTER bits at most
        data = np.frombuffer(zstandard.decompress(r["bits"]), np.uint8)
        found[r["row"]][r["place"] // 8 : r["place"] // 8 + len(data)] = data
    return [x.tobytes() for x in found]


def _by_hash(at: np.ndarray, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs in parts of about ``STEP``; those of one hash are in the same part."""
    n = -(-len(h) // STEP)
    part = ((h >> np.uint64(32)) % np.uint64(max(1, n))).astype(np.uint32)
    for p in range(n):
        some = np.flatnonzero(part == p)
        if len(some):
            yield at[some], h[some]


def _exact(chunk: Chunk, ids: np.ndarray, n: int, at: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs as rows of word numbers, with their counts in the chunk."""
    order = np.argsort(h, kind="stable")
    at, h = at[order], h[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])[: len(h)])
    lead, counts = at[first], np.diff(np.append(first, len(h)))
    same = np.repeat(lead, counts)
    if all(np.array_equal(ids[at + k], ids[same + k]) for k in range(n)):
        return np.stack([ids[lead + k] for k in range(n)], 1), counts
    return np.unique(np.stack([ids[at + k] for k in range(n)], 1), axis=0, return_counts=True)  # two runs of one hash


def gathered(texts: DataFrame) -> DataFrame:
    """Two partitions a task where there are several for each core, so that a run met in both is sent once."""
    n = texts.rdd.getNumPartitions()
    return texts.coalesce(n // 2) if n >= 4 * texts.sparkSession.sparkContext.defaultParallelism else texts


def run_counts(texts: DataFrame, bits: list[bytes], width: int) -> DataFrame:
    """``lang, words, phrase, a``: part counts of the runs that pass the filter; a row without words is how many words a language has."""
    shared, folded = texts.sparkSession.sparkContext.broadcast(bits), min(width, FILTER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state(("collocations",), dict)
        rows = [np.frombuffer(b, np.uint8) for b in shared.value]

        def passing(h: np.ndarray, row: int) -> np.ndarray:
            cell = cells(h, row, width) & np.uint64(folded - 1)
            return (rows[row][cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

        for chunk in chunks(batches):
            ids = chunk.ids()
            totals = Counter()
            for lang, n in zip(chunk.langs[1:], np.bincount(ids, minlength=len(chunk.words))[1:].tolist(), strict=True):
                totals[lang] += n
            yield _counted([*totals], 0, [None] * len(totals), [*totals.values()])
            kept = [([np.zeros(0, np.int32)], [np.zeros(0, np.uint64)]) for _ in range(MAX_WORDS)]
            for n, at, h in chunk.runs(ids):
                for row in (0, 1):
                    passed = passing(h, row)
                    at, h = at[passed], h[passed]
                kept[n - 1][0].append(at)
                kept[n - 1][1].append(h)
            for n in range(MAX_WORDS, 0, -1):
                for at, h in _by_hash(*map(np.concatenate, kept.pop())):
                    runs, counts = _exact(chunk, ids, n, at, h)
                    for first in range(0, len(runs), SENT):
                        part = runs[first : first + SENT].tolist()
                        yield _counted([chunk.langs[r[0]] for r in part], n, [b" ".join([chunk.words[w] for w in r]) for r in part], counts[first : first + SENT])
            del chunk, ids

    def _counted(langs, n, phrases, counts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(np.full(len(langs), n, np.int32)), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["lang", "words", "phrase", "a"])

    return gathered(texts).mapInArrow(run, "lang string, words int, phrase string, a long").groupBy("lang", "words", "phrase").agg(F.sum("a").alias("a"))


def frequent_runs(docs: DataFrame, least: int) -> DataFrame:
    """``lang, words, phrase, a``: all runs of ``least`` or more occurrences with their exact counts, and a row without words for each language's number of words."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    width, block = sketch_shape(size // 2)  # a run of words begins at every second byte or less often
    bits = heavy_filter(texts, least, width, block)
    return run_counts(texts, bits, width).filter((F.col("words") == 0) | (F.col("a") >= least))


def collocations(docs: DataFrame, least: int = 30, cover: int = 80, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top`` phrases of two to ``MAX_WORDS`` words.

    A phrase goes where a longer one holds its words side by side and is ``cover`` in a hundred times as frequent.
    """
    runs = staged(frequent_runs(docs, least), "phrase_runs")
    counts, found = runs.filter("words > 0"), runs.filter("words > 1")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - words)")})
    of = lambda part, name: counts.select("lang", F.col("phrase").alias(part), F.col("a").alias(name))
    cuts = cuts.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"])
    score = F.expr("CAST(a AS DECIMAL(20, 0)) * 2000000 DIV CAST(l + r AS DECIMAL(20, 0))")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c")).select("lang", "phrase", "a", "c.score", "c.l", "c.r")

    split = F.split("phrase", " ")
    inner = [F.concat_ws(" ", F.slice(split, i + 1, m)) for n in range(3, MAX_WORDS + 1) for m in range(2, n) for i in range(n - m + 1)]
    of_words = [n for n in range(3, MAX_WORDS + 1) for m in range(2, n) for i in range(n - m + 1)]
    subs = F.array_compact(F.array(*[F.when(F.col("words") == n, c) for n, c in zip(of_words, inner, strict=True)]))
    covers = found.filter("words > 2").select("lang", F.explode(subs).alias("phrase"), F.col("a").alias("over")).groupBy("lang", "phrase").agg(F.max("over").alias("over"))
    kept = scored.join(covers, ["lang", "phrase"], "left").filter(F.expr(f"over IS NULL OR CAST(over AS DECIMAL(20, 0)) * 100 < CAST(a AS DECIMAL(20, 0)) * {int(cover)}"))

    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = kept.withColumn("rank", rank).filter(F.col("rank") <= top)
    n = runs.filter("words = 0").select("lang", F.col("a").alias("n"))
    return best.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


OP13_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, len, array_to_string(ws[i : i + len - 1], ' ') AS phrase FROM w, range(1, 5) l(len), unnest(range(1, len(ws) - len + 2)) s(i)),
f AS (SELECT lang, len, phrase, count(*) AS a FROM g GROUP BY 1, 2, 3),
n AS (SELECT lang, sum(a) AS n FROM f WHERE len = 1 GROUP BY 1),
c AS (SELECT * FROM f WHERE len > 1 AND a >= 30),
cuts AS (SELECT lang, len, phrase, a, k, array_to_string(string_split(phrase, ' ')[1 : k], ' ') AS first, array_to_string(string_split(phrase, ' ')[k + 1 :], ' ') AS rest FROM c, range(1, 4) r(k) WHERE k < len),
s AS (
  SELECT cuts.*, l.a AS l, r.a AS r, ((2000000 * cuts.a::HUGEINT) // (l.a + r.a))::BIGINT AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = first AND l.len = k JOIN f r ON r.lang = cuts.lang AND r.phrase = rest AND r.len = cuts.len - k
), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[i : i + m - 1], ' ') AS phrase, max(a) AS over
  FROM c, range(2, 4) x(m), range(1, 4) y(i) WHERE m < len AND i + m - 1 <= len GROUP BY 1, 2
), k AS (SELECT b.* FROM b LEFT JOIN o USING (lang, phrase) WHERE over IS NULL OR 100 * over::HUGEINT < 80 * b.a::HUGEINT),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM k)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n.n::BIGINT AS n, score FROM z JOIN n USING (lang) WHERE rank <= 2000
"""
