"""Operator 2: toxicity of deobfuscated text.

Writers hide words as "1d10t", "i d i o t" or "idiiiot". A noisy channel models that:
the hidden text comes from a character trigram model, counted over all documents, and a channel
writes its letters as look-alike signs, spreads them with separators or repeats
them. Each stretch that the channel can have touched becomes a lattice of
readings, and a Viterbi pass finds the likeliest; elsewhere the lattice has one path. The restored
words and their character 4- to 6-grams are hashed features of a logistic regression.

The regression is fitted on at most ``SAMPLE`` labelled training rows, taken by
the hash of their id; its features are the ``FEATURES`` buckets that tell the
labels apart best. Everything else covers all documents.

Cases: null and empty texts have no features and get the score of the intercept; null
ids are scored, but never held out or learned from; rows without a 0/1 label
are not learned from; an id that is labelled both ways counts as toxic; repeated rows are scored each, and learned
from within the same bound; without any
training rows of both labels the score is the (smoothed) share of toxic ones; an empty table
gives an empty result; other columns are carried or ignored, never read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwharf.llm.common import first_by_hash, staged, with_fields, worker_memo

#: Labelled rows that the regression is fitted on, at most, and its features.
SAMPLE, FEATURES = 20_000, 4096
BUCKETS = 1 << 18
GRAMS = (4, 5, 6)
#: Log-likelihood that a bucket must gain by telling the labels apart to become a feature.
MIN_GAIN = 8.0
# The letters that a sign may stand for.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e"}
#: Negative log probabilities of the channel.
AS_SIGN, REPEATED, JOINED, DROPPED, DROPPED_EDGE, HALVED = 1.0, 0.5, 0.5, 4.0, 0.7, 3.0
SYMBOLS = 28  # a boundary, a to z, any other letter
_ALPHABET = bytes((b | 32) - 96 if chr(b).isascii() and chr(b).isalpha() else 27 if b >= 0x80 else 0 for b in range(256))
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S(?!\S)){2,}")
#: A letter three times, or two letters twice.
_REPEATED = re.compile(r"(.)\1\1|(.)\2.*(.)\3")
_EDGES = ".,;:!?'\"()[]{}<>#$%&*|-_/\\"
_TAIL = ".,;:!?'\")]}>"


def trigram_counts(text: str | None) -> np.ndarray:
    """Counts of the 28^3 symbol trigrams, runs of boundaries included."""
    s = np.frombuffer(b" " + (text or "").encode("utf-8", "surrogatepass") + b" ", np.uint8)
    s = np.frombuffer(s.tobytes().translate(_ALPHABET), np.uint8).astype(np.int32)
    return np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)


def language_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Costs [a, b, c] = -log P(c | a, b), interpolated with shorter contexts, from all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += trigram_counts(text.as_py())
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "n"])

    rows = docs.select(text_col).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()  # at most 28^3
    n = np.zeros(SYMBOLS**3)
    for r in rows:
        n[r["gram"]] = r["n"]
    return costs(n.reshape(SYMBOLS, SYMBOLS, SYMBOLS))


def costs(n: np.ndarray) -> np.ndarray:
    one = (n.sum((0, 1)) + 1) / (n.sum() + SYMBOLS)
    two = (n.sum(0) + 5 * one) / (n.sum((0, 2)) + 5)[:, None]
    return -np.log((n + 5 * two[None]) / (n.sum(2) + 5)[:, :, None])


class Restorer:
    """Viterbi decoding of obfuscated stretches; everything in lower case."""

    def __init__(self, cost: np.ndarray):
        self.cost = cost.tolist()

    @staticmethod
    def symbol(c: str) -> int:
        return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0

    def _readings(self, c: str, n: int, edge: bool) -> list[tuple[str, float]]:
        """What a run of n equal characters may have been."""
        if c.isalpha():
            return [(c * n, 0.0)] + ([(c, HALVED)] if n == 2 else []) if n < 3 else [(c, REPEATED), (c * 2, REPEATED)]
        if c.isspace():
            return [("", JOINED), (" ", JOINED)]
        out = [("", DROPPED_EDGE if edge or c not in LOOKALIKES else DROPPED)]
        for letter in LOOKALIKES.get(c, ""):
            out += [(letter * min(n, 2), AS_SIGN * min(n, 2))] + ([(letter, AS_SIGN + REPEATED)] if n > 1 else [])
        return out

    def decode(self, stretch: str) -> str:
        units = [(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", stretch, re.S)]
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for k, (c, n) in enumerate(units):
            new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for reading, channel in self._readings(c, n, k in (0, len(units) - 1)):
                symbols = [self.symbol(x) for x in reading]
                for (a, b), (cost, path) in states.items():
                    cost += channel
                    for s in symbols:
                        cost += self.cost[a][b][s]
                        a, b = b, s
                    if (a, b) not in new or cost < new[a, b][0]:
                        new[a, b] = cost, (reading, path) if reading else path
            states = new
        _, path = min(((cost + self.cost[a][b][0], path) for (a, b), (cost, path) in states.items()), key=lambda x: x[0])
        out = []
        while path:
            out.append(path[0])
            path = path[1]
        return "".join(reversed(out))

    def word(self, word: str) -> list[str]:
        """The readings of one word: itself without its edges if it has plain letters, and what the channel may have hidden."""
        core = word.strip(_EDGES)
        plain = core.isalpha()
        if plain and not _REPEATED.search(core) and (len(core) == len(word) or not set(word.rstrip(_TAIL)[:1]) & LOOKALIKES.keys()):
            return [core]
        if not any(map(str.isalpha, word)) and (len(core) < 3 or not set(core) <= LOOKALIKES.keys()):
            return []
        restored = self.decode(word.rstrip(_TAIL) or word).split()
        return [*([core] if plain else []), *restored]

    def spaced(self, text: str) -> list[str]:
        """The words read from stretches of single characters."""
        found = []
        for m in _SPACED.finditer(text):
            letters = re.sub(r"(\S)(?:\s+\1){2,}", r"\1", m[0])  # one letter again and again spells no word
            if len(letters) > 2:
                found += self.decode(letters).split()
        return found


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def gram_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of words in UTF-8, their grams' buckets and whose they are: the CRC-32 of each, carried on over all places at once."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    owner = np.repeat(np.arange(len(words)), sizes)[starts]
    chars = np.bincount(owner, minlength=len(words))
    left = np.repeat(np.cumsum(chars), chars) - np.arange(len(starts))  # characters from each to its word's end
    ends = np.append(starts, np.full(GRAMS[-1], len(data)))
    state, at, found, whose = np.full(len(starts), 0xFFFFFFFF, np.uint32), starts, [], []
    for k in range(1, GRAMS[-1] + 1):
        size = np.where(left >= k, ends[k : k + len(starts)] - at, 0)  # bytes of the k-th character
        for t in range(int(size.max(initial=0))):
            more = size > t
            if more.all():
                state = _CRC[(state ^ data[at + t]) & 255] ^ (state >> np.uint32(8))
            else:
                part = state[more]
                state[more] = _CRC[(part ^ data[at[more] + t]) & 255] ^ (part >> np.uint32(8))
        at = at + size
        if k in GRAMS:
            inside = left >= k
            found.append((~state[inside]) % np.uint32(BUCKETS))
            whose.append(owner[inside])
    return np.concatenate(found).astype(np.int64), np.concatenate(whose)


def doubled(words: list[str]) -> np.ndarray:
    """How often each word has one character twice in a row."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    same = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    return np.bincount(owner[1:][same], minlength=len(words))


class Features:
    """The feature buckets of texts; ``keep`` maps buckets to features, others vanish. Words are remembered under ``name``.

    Words that a batch of texts brings anew are worked out together.
    """

    #: Texts worked on together.
    TOGETHER = 256

    def __init__(self, cost: np.ndarray, keep: np.ndarray | None = None, name: str = ""):
        self.restorer, self.memo = Restorer(cost), worker_memo(("toxic", name or uuid.uuid4().hex), lambda: self._of)
        self.place = None
        if keep is not None:
            self.place = np.full(BUCKETS, -1, np.int64)
            self.place[keep] = np.arange(len(keep))

    def _of(self, word: str) -> tuple[int, ...]:
        return self._many([word])[0]

    def _many(self, words: list[str]) -> list[tuple[int, ...]]:
        """The features of each word: those of all its readings."""
        padded, whose = [], []
        for i, (word, pairs) in enumerate(zip(words, doubled(words).tolist(), strict=True)):
            # a plain word needs two pairs at least for what the channel does by repetition
            for w in [word] if pairs < 2 and word.isalpha() else self.restorer.word(word):
                padded.append(f"^{w}$".encode("utf-8", "surrogatepass"))
                whose.append(i)
        if not padded:
            return [()] * len(words)
        whose = np.array(whose)
        part, of = gram_buckets(padded)
        whole = np.fromiter(map(zlib.crc32, padded), np.int64, len(padded)) % BUCKETS
        buckets, owner = np.concatenate([part, whole]), np.concatenate([whose[of], whose])
        if self.place is not None:
            features = self.place[buckets]
            owner, buckets = owner[features >= 0], features[features >= 0]
        out: list[tuple[int, ...]] = [()] * len(words)
        if len(owner):
            both = np.unique(owner * BUCKETS + buckets)
            owner, buckets = both // BUCKETS, both % BUCKETS
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            for i, part in zip(owner[first].tolist(), np.split(buckets, first[1:]), strict=True):
                out[i] = tuple(part.tolist())
        return out

    def _words(self, text: str | None) -> set[str]:
        text = (text or "").lower()
        words = set(text.split())
        if _SPACED.search(text):
            words.update(self.restorer.spaced(text))
        return words

    def texts(self, texts: Iterator[str | None]) -> Iterator[np.ndarray]:
        while some := list(islice(texts, self.TOGETHER)):
            words = [self._words(t) for t in some]
            known = self.memo.known(set().union(*words), self._many)
            for own in words:
                found = set()
                for f in map(known.__getitem__, own):
                    if f:
                        found.update(f)
                yield np.fromiter(found, np.int32, len(found))


def fit_logistic(rows: list[np.ndarray], labels: np.ndarray, n: int, l2: float = 0.2, rounds: int = 600) -> np.ndarray:
    """Weights of binary features and, last, the intercept; accelerated full gradients with step 1 / (bound of the curvature)."""
    w = np.zeros(n + 1)
    share = (labels.sum() + 1) / (len(labels) + 2)
    w[-1] = np.log(share / (1 - share))
    if not rows or labels.min() == labels.max():
        return w
    if not n or not any(map(len, rows)):
        return w
    lens = np.array([len(r) for r in rows])
    at, doc = np.concatenate(rows).astype(np.int64), np.repeat(np.arange(len(rows)), lens)
    df = np.bincount(at, minlength=n)
    # a diagonal bound: curvature of feature i is at most a quarter of the summed sizes of its rows
    bound = np.append(0.25 * np.bincount(at, weights=(lens + 1.0)[doc], minlength=n), 0.25 * (lens + 1.0).sum()) + l2
    free, before = np.append(df > 0, True), w.copy()
    for k in range(rounds):
        y = w + (k / (k + 3)) * (w - before)
        z = np.bincount(doc, weights=y[at], minlength=len(rows)) + y[-1]
        r = 1 / (1 + np.exp(-z)) - labels
        g = np.append(np.bincount(at, weights=r[doc], minlength=n) + l2 * y[:-1], r.sum())
        before, w = w, np.where(free, y - g / bound, 0.0)
    return w


class Model:
    def __init__(self, cost: np.ndarray, keep: np.ndarray, weights: np.ndarray):
        self.cost, self.keep, self.weights = cost, keep, weights

    def scores(self, texts: Iterator[str | None], features: Features) -> np.ndarray:
        z = np.array([self.weights[f].sum() + self.weights[-1] for f in features.texts(texts)], np.float64)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out_mod: int = 5) -> Model:
    """Learn from the labelled rows whose crc32(id) mod ``held_out_mod`` is not 0."""
    spark = docs.sparkSession
    cost = language_model(docs, text_col)
    learn = labels.filter((F.crc32(F.col(id_col).cast("string")) % held_out_mod != 0) & F.col(label_col).isin(0, 1))
    one = staged(learn.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_y")), "toxic_labels")
    sample = F.broadcast(staged(first_by_hash(one, ["_id"], SAMPLE, one.count()), "toxic_sample"))  # at most SAMPLE rows
    shared = spark.sparkContext.broadcast(cost)

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(shared.value)
        for batch in batches:
            rows = list(features.texts(t.as_py() for t in batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("y"), pa.array(rows, pa.list_(pa.int32()))], ["k", "y", "f"])

    joined = docs.join(sample, F.col(id_col) == F.col("_id"))
    joined = joined.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("k"), F.col("_y").cast("int").alias("y"), F.col(text_col).alias("text"))
    known = staged(joined.mapInArrow(buckets, "k long, y int, f array<int>"), "toxic_features")
    if (met := known.count()) > SAMPLE:  # ids that documents repeat
        known = staged(first_by_hash(known, ["k"], SAMPLE, met), "toxic_features_bounded")
    n, n1 = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < n1 < n:
        return Model(cost, np.zeros(0, np.int64), np.array([np.log((n1 + 1) / (n - n1 + 1))]))
    a, d = F.col("a"), F.col("d")
    xlx = lambda x: F.when(x > 0, x * F.log(x)).otherwise(0.0)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            y = np.repeat(batch.column("y").to_numpy(), np.diff(batch.column("f").offsets.to_numpy()))
            f = batch.column("f").flatten().to_numpy()
            count += np.stack([np.bincount(f[y == 1], minlength=BUCKETS), np.bincount(f, minlength=BUCKETS)])
        some = np.flatnonzero(count[1])
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[0][some]), pa.array(count[1][some])], ["f", "a", "d"])

    per = known.mapInArrow(spread, "f int, a long, d long").groupBy("f").agg(F.sum("a").cast("double").alias("a"), F.sum("d").cast("double").alias("d"))
    base = sum((-1 if k else 1) * m * np.log(m) for k, m in enumerate((n, n1, n - n1)))
    gain = xlx(a) + xlx(d - a) + xlx(n1 - a) + xlx((n - n1) - (d - a)) - xlx(d) - xlx(n - d) + float(base)
    best = per.withColumn("g", gain).filter(F.col("g") >= MIN_GAIN).orderBy(F.desc("g"), "f").limit(FEATURES).select("f").collect()
    keep = np.array([r["f"] for r in best], np.int64)
    place = np.full(BUCKETS, -1)
    place[keep] = np.arange(len(keep))
    shared_place = spark.sparkContext.broadcast(place)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(x := shared_place.value[np.array(f.as_py(), np.int64)])[x >= 0] for f in batch.column("f")]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(rows, pa.list_(pa.int32()))], ["y", "f"])

    table = known.mapInArrow(select, "y int, f array<int>").toArrow()  # at most SAMPLE rows
    rows = [np.array(f.as_py(), np.int32) for f in table.column("f")]
    return Model(cost, keep, fit_logistic(rows, table.column("y").to_numpy().astype(float), len(keep)))


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_score`` added."""
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        features = Features(m.cost, m.keep, name)
        for batch in batches:
            scores = m.scores((t.as_py() for t in batch.column(text_col)), features)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, "_score"])

    return docs.mapInArrow(run, with_fields(docs, _score="double"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = score_toxicity(docs, train(docs, labels))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))
