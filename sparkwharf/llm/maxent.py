"""Operator 6: a hashed maximum-entropy language model with class-factored softmax.

P(token | history) = P(cluster | history) * P(member | cluster, history) * P(slot | member, history) * P(token | slot).
The first three factors are softmaxes over weights of hashed features of the
history: the word before, the two words before, and the one before that (a skip
feature). A slot is one word, the most frequent ones of a member class having one each, or all the rest of its class, in which
the last factor is the token's smoothed share. Clusters come from which
frequent words the words follow, known for frequent words and, through the spelling's
end, for all others; members split a cluster by frequency.

Texts are turned into ids once, and the ids are kept in a table. Training streams those of all training documents once: in each round, every task makes
AdaGrad updates over its part from the shared weights, and the weights are averaged by
how often each feature was met, in a tree of sums. What is broadcast is bounded by the model's
parameters: at most ``HEAD`` most frequent words and the weights. All rarer words get their counts by a
join on the word, so no count is cut off; as they are rare by choice, none is a hot key there.

Cases: null and empty texts are one end token; null ids are scored, never learned
from or held out; repeated rows are scored each; without training
documents all counts are zero and every base score is 0; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwharf.llm.common import staged, worker_state

#: Words with an entry in the broadcast dictionary; frequent words; words that clusters are told by.
HEAD, FREQUENT, ANCHORS = 1 << 19, 512, 128
CLUSTERS, MEMBERS = 8, 8
#: Member classes: the most frequent words of a cluster alone, then bands of rank, then all words beyond HEAD.
SINGLES, BANDS = 4, (FREQUENT, 1 << 14)
#: Words of a class that are predicted from the history, less one for its rest; hashed rows of their weights.
SLOTS, ROWS3 = 8, 1 << 16
ENDINGS, ENDING = 1024, 3
#: Feature buckets of one word of history (the first half for frequent words) and of two.
ONE, TWO = 4096, 8192
ROUNDS, BATCH_BITS, RATE = 2, 15, 0.15
BATCH = 1 << BATCH_BITS
#: Words a counting task holds before it hands them on; tasks whose weights meet in one sum.
HELD, FAN_IN = 500_000, 16
END = 0  # id of the end token; the head's words follow
BEGIN = HEAD + ENDINGS + 1
_EDGES = b".,;:!?#$%&*|\"'()"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def ending(word: bytes) -> int:
    return zlib.crc32((word.rstrip(_EDGES) or word)[-ENDING:]) % ENDINGS


def entity(ids: np.ndarray, head_endings: np.ndarray) -> np.ndarray:
    """What decides a token's cluster: itself if frequent, else its ending."""
    return np.where(ids < FREQUENT, ids, FREQUENT + head_endings[ids])


class Head:
    """Ids of tokens: the end, the frequent words by rank, then one id for each ending of other words."""

    def __init__(self, listed: list[bytes]):
        self.ids = {w: i for i, w in enumerate(listed, 1)}
        # of every id, the ending
        self.endings = np.zeros(BEGIN + 1, np.int32)
        self.endings[1 : len(listed) + 1] = [ending(w) for w in listed]
        self.endings[HEAD + 1 : HEAD + 1 + ENDINGS] = np.arange(ENDINGS)

    def encode(self, ws: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """Ids with the end token, and the words beyond the head."""
        get = self.ids.get
        ids = np.array([get(w, -1) for w in ws] + [END], np.int32)
        rare = np.flatnonzero(ids < 0)
        other = [ws[i] for i in rare.tolist()]
        if other:
            ids[rare] = [HEAD + 1 + ending(w) for w in other]
        return ids, other


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _bucket(x: np.ndarray) -> np.ndarray:
    return np.where(x < ONE // 2, x, ONE // 2 + (_mix(x.astype(np.uint64)) % np.uint64(ONE // 2)).astype(np.int64))


def features(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(3, n) feature buckets; ``first`` marks the tokens that begin a document."""
    one = np.empty(len(ids), np.int64)
    one[1:], one[0] = ids[:-1], BEGIN
    one[first] = BEGIN
    two = np.empty_like(one)
    two[1:], two[0] = one[:-1], BEGIN
    two[first] = BEGIN
    both = _mix((one << 24 | two).view(np.uint64)) % np.uint64(TWO)
    out = np.empty((3, len(ids)), np.int64)
    out[0], out[1] = _bucket(one), ONE + both.view(np.int64)
    out[2, 1:], out[2, 0] = out[0, :-1], BEGIN_BUCKET  # the bucket of the word before the last is the last one's a token ago
    out[2, first] = BEGIN_BUCKET
    out[2] += ONE + TWO
    return out


BEGIN_BUCKET = int(_bucket(np.array([BEGIN], np.int64))[0])


def _summed(w: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Of each token, its three rows' weights and the bias; ``take`` copies whole rows, which indexing doesn't."""
    z = w.take(rows[0], axis=0)
    z += w.take(rows[1], axis=0)
    z += w.take(rows[2], axis=0)
    z += bias
    return z


def _shares(z: np.ndarray) -> np.ndarray:
    """Softmax of each row, in place."""
    z -= np.maximum.reduce(z.T.copy(), axis=0)[:, None]  # along rows of the transposed copy, as rows themselves are short
    np.exp(z, out=z)
    z /= np.einsum("ij->i", z)[:, None]
    return z


class Model:
    """``cluster``, ``member`` and ``slot`` by id; ``inside``: log10 of a token's share of its slot, for head ids, and minus log10 of the slot's size for others."""

    def __init__(self, cluster: np.ndarray, member: np.ndarray, slot: np.ndarray, several: np.ndarray, inside: np.ndarray, bias1: np.ndarray, bias2: np.ndarray, bias3: np.ndarray):
        self.cluster, self.member, self.slot, self.several, self.inside = cluster, member, slot, several, inside
        n = 2 * ONE + TWO
        self.b1, self.b2, self.b3 = (b.astype(np.float32) for b in (bias1, bias2, bias3))
        self.w1, self.w2, self.w3 = np.zeros((n, CLUSTERS), np.float32), np.zeros((n * CLUSTERS, MEMBERS), np.float32), np.zeros((ROWS3, SLOTS), np.float32)

    def tables(self) -> list[np.ndarray]:
        return [self.w1, self.w2, self.w3]

    def _rows3(self, f: np.ndarray, cls: np.ndarray) -> np.ndarray:
        return (_mix((f * (CLUSTERS * MEMBERS) + cls).astype(np.uint64)) % np.uint64(ROWS3)).astype(np.int64)

    def _softmax3(self, g: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """Slots of classes that have several."""
        return _shares(_summed(self.w3, g, self.b3.take(cls, axis=0)))

    def _softmax(self, f: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _shares(_summed(self.w1, f, self.b1)), _shares(_summed(self.w2, f * CLUSTERS + c, self.b2.take(c, axis=0)))

    def log10(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of each token; for ids beyond the head, all but log10(count + 1)."""
        out = np.empty(len(ids))
        f, c, m = features(ids, first), self.cluster[ids], self.member[ids]
        for k in range(0, len(ids), BATCH):
            s = slice(k, k + BATCH)
            p1, p2 = self._softmax(f[:, s], c[s])
            rows = np.arange(len(p1))
            p = p1[rows, c[s]].astype(np.float64) * p2[rows, m[s]]
            cls = c[s] * MEMBERS + m[s]
            at = np.flatnonzero(self.several[cls])
            if len(at):
                p3 = self._softmax3(self._rows3(f[:, s][:, at], cls[at]), cls[at])
                p[at] *= p3[np.arange(len(at)), self.slot[ids[s][at]]]
            out[s] = np.log10(np.maximum(p, 1e-60))
        return out + self.inside[ids]

    def start(self) -> None:
        self.g1, self.g2, self.g3 = (np.full_like(w, 1e-2) for w in self.tables())
        self.met1, self.met2, self.met3 = (np.zeros(len(w), np.float32) for w in self.tables())

    def update(self, ids: np.ndarray, first: np.ndarray) -> None:
        f_all, c_all, m_all = features(ids, first), self.cluster[ids], self.member[ids]
        for k in range(0, len(ids), BATCH):
            s = slice(k, k + BATCH)
            f, c, m = f_all[:, s], c_all[s], m_all[s]
            p1, p2 = self._softmax(f, c)
            rows = np.arange(len(c))
            p1[rows, c] -= 1
            p2[rows, m] -= 1
            for slot in f:
                row, order = _sorted(slot * CLUSTERS + c)  # in order of both tables' rows
                _step(self.w1, self.g1, self.met1, row // CLUSTERS, p1.take(order, axis=0))
                _step(self.w2, self.g2, self.met2, row, p2.take(order, axis=0))
            cls = c * MEMBERS + m
            at = np.flatnonzero(self.several[cls])
            if len(at):
                g = self._rows3(f[:, at], cls[at])
                p3 = self._softmax3(g, cls[at])
                p3[np.arange(len(at)), self.slot[ids[s][at]]] -= 1
                for slot in g:
                    row, order = _sorted(slot)
                    _step(self.w3, self.g3, self.met3, row, p3.take(order, axis=0))


def _sorted(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a batch in order, and their places; a row and its place are sorted as one number."""
    key = np.sort(at << BATCH_BITS | np.arange(len(at)))
    return key >> BATCH_BITS, key & (BATCH - 1)


def _step(w: np.ndarray, g2: np.ndarray, met: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
    """AdaGrad over ``rows`` in order and their gradients."""
    cut = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    n, rows, summed = np.diff(np.append(cut, len(rows))), rows[cut], np.add.reduceat(gradient, cut, axis=0)
    met[rows] += n
    seen = g2.take(rows, axis=0) + summed**2
    g2[rows] = seen
    w[rows] -= RATE * summed / np.sqrt(seen)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of whole documents, 4 * BATCH or more at a time, and where documents begin."""
    for batch in batches:
        column, at = batch.column("ids"), 0
        ends = column.offsets.to_numpy().astype(np.int64)
        values = column.values.to_numpy()
        while at < batch.num_rows:
            to = min(batch.num_rows, max(at + 1, int(np.searchsorted(ends, ends[at] + 4 * BATCH))))
            yield values[ends[at] : ends[to]], ends[at:to] - ends[at]
            at = to


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, c`` over all ``texts(text)``; partial counts are combined before and after the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen.update(words(text.as_py()))
                if len(seen) > HELD:
                    yield _counted(seen)
                    seen = Counter()
        yield _counted(seen)

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _counted(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "c"])


def neighbours(coded: DataFrame, head: Callable[[], Head]) -> np.ndarray:
    """How often each entity comes after each anchor as the last one before it."""
    entities = FREQUENT + ENDINGS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, total = head(), np.zeros(entities * ANCHORS, np.int64)
        for ids, starts in _chunks(batches):
            is_anchor = (ids < ANCHORS) & (ids != END)
            place = np.where(is_anchor, np.arange(len(ids)), -1)
            last = np.concatenate([[-1], np.maximum.accumulate(place)[:-1]])
            begin = np.repeat(starts, np.diff(np.append(starts, len(ids))))
            ok = last >= begin
            total += np.bincount(entity(ids[ok], h.endings).astype(np.int64) * ANCHORS + ids[last[ok]], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["cell", "n"])

    rows = coded.select("ids").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most entities x ANCHORS rows
    out = np.zeros(entities * ANCHORS)
    out[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(entities, ANCHORS)


def cluster_entities(near: np.ndarray) -> np.ndarray:
    """k-means of the entities in the space of the leading singular vectors of their centred profiles; fixed starts."""
    n = near.sum()
    if not n:
        return np.zeros(len(near), np.int64)
    size = near.sum(1)
    expected = np.outer(size, near.sum(0)) / n
    residual = (near - expected) / np.sqrt(expected + 1)
    u, s, _ = np.linalg.svd(residual, full_matrices=False)
    x = (u * s)[:, :CLUSTERS]
    x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
    centres = x[[int(np.argmax(size))]]
    for _ in range(CLUSTERS - 1):  # the next start is the heaviest far entity
        far = ((x[:, None] - centres[None]) ** 2).sum(2).min(1)
        centres = np.vstack([centres, x[int(np.argmax(far * np.sqrt(size)))]])
    for _ in range(30):
        mine = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        for k in range(len(centres)):
            if size[mine == k].sum():
                centres[k] = (x[mine == k] * size[mine == k, None]).sum(0) / size[mine == k].sum()
    return mine


def build_model(head: Head, head_counts: np.ndarray, n_end: int, tail: np.ndarray, near: np.ndarray) -> Model:
    """``tail``: (ENDINGS, 2) token and word counts beyond the head."""
    of = cluster_entities(near)
    ids = np.arange(BEGIN + 1)
    cluster = of[np.minimum(entity(ids, head.endings), len(of) - 1)].astype(np.int32)
    member = np.full(BEGIN + 1, MEMBERS - 1, np.int32)
    counts, kinds = np.zeros(BEGIN + 1), np.zeros(BEGIN + 1)
    counts[END], kinds[END] = n_end, 1
    counts[1 : len(head_counts) + 1], kinds[1 : len(head_counts) + 1] = head_counts, 1
    counts[HEAD + 1 : BEGIN], kinds[HEAD + 1 : BEGIN] = tail[:, 0], tail[:, 1]
    listed = len(head_counts) + 1
    member[:listed] = SINGLES + np.searchsorted(BANDS, ids[:listed], side="right")
    for k in range(CLUSTERS):
        mine = np.flatnonzero(cluster[:listed] == k)[:SINGLES]
        member[mine] = np.arange(len(mine))
    cls = cluster * MEMBERS + member
    size = np.bincount(cls, weights=counts, minlength=CLUSTERS * MEMBERS)
    types = np.bincount(cls, weights=kinds, minlength=CLUSTERS * MEMBERS)
    types[MEMBERS - 1 :: MEMBERS] += 1  # all words never met, in each cluster's last class
    slot = np.zeros(BEGIN + 1, np.int32)
    for k in range(CLUSTERS * MEMBERS):
        mine = np.flatnonzero(cls[:listed] == k)  # in order of frequency
        slot[mine] = np.minimum(np.arange(len(mine)), SLOTS - 1)
    several = np.bincount(cls, weights=slot > 0, minlength=CLUSTERS * MEMBERS) > 0
    slot[listed:][several[cls[listed:]]] = SLOTS - 1
    whole, n_slots = cls * SLOTS + slot, CLUSTERS * MEMBERS * SLOTS
    size3 = np.bincount(whole, weights=counts, minlength=n_slots) + np.bincount(whole, weights=kinds, minlength=n_slots)
    last = np.arange(MEMBERS - 1, CLUSTERS * MEMBERS, MEMBERS)
    size3[last * SLOTS + np.where(several[last], SLOTS - 1, 0)] += 1  # words never met
    inside = -np.log10(np.maximum(size3, 1))[whole]
    inside[:listed] += np.log10(counts[:listed] + 1)
    grid = (size + types).reshape(CLUSTERS, MEMBERS)
    return Model(
        cluster, member, slot, several, inside, np.log(np.maximum(grid.sum(1), 1e-3)), np.log(np.maximum(grid, 1e-3)),
        np.log(np.maximum(size3, 1e-3)).reshape(CLUSTERS * MEMBERS, SLOTS),
    )


def _averaged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of (met, met * weights) rows by key, streamed over sorted partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for batch in batches:
            for row in batch.to_pylist():
                k, x = [row[n] for n in keys], np.frombuffer(row["sums"], np.float32)
                if k == key:
                    total = total + x
                    continue
                if key is not None:
                    yield pa.RecordBatch.from_pylist([{**dict(zip(keys, key)), "sums": total.tobytes()}], schema=kind)
                key, total = k, x
        if key is not None:
            yield pa.RecordBatch.from_pylist([{**dict(zip(keys, key)), "sums": total.tobytes()}], schema=kind)

    kind = pa.schema([*[(k, pa.int32()) for k in keys], ("sums", pa.binary())])
    return parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, ", ".join(f"{k} int" for k in keys) + ", sums binary")


def train_round(coded: DataFrame, model: Model) -> Model:
    """One round of distributed updates over ``coded(ids)``; the weights averaged by how often each row was met."""
    spark = coded.sparkSession
    shared, block = spark.sparkContext.broadcast(model), 4096

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model.__new__(Model)
        m.__dict__.update(shared.value.__dict__)
        m.w1, m.w2, m.w3 = (w.copy() for w in m.tables())
        m.start()
        any_rows = False
        for ids, starts in _chunks(batches):
            m.update(ids, starts)
            any_rows = True
        salt = TaskContext.get().partitionId()
        if any_rows:
            for table, (w, met) in enumerate(zip(m.tables(), (m.met1, m.met2, m.met3), strict=True)):
                for k in range(0, len(w), block):
                    n = met[k : k + block, None]
                    sums = np.concatenate([n, n * w[k : k + block]], axis=1, dtype=np.float32)
                    yield pa.RecordBatch.from_pydict({"part": pa.array([table << 16 | k // block], pa.int32()), "salt": pa.array([salt], pa.int32()), "sums": [sums.tobytes()]})

    sums = coded.select("ids").mapInArrow(run, "part int, salt int, sums binary")
    for _ in range(2):  # FAN_IN tasks' rows meet in a sum, then FAN_IN sums' rows
        sums = _averaged(sums.withColumn("salt", F.floor(F.col("salt") / FAN_IN).cast("int")), ["part", "salt"])
    sums = _averaged(sums, ["part"])
    for r in sums.toLocalIterator():  # as large as the model
        table, k = model.tables()[r["part"] >> 16], (r["part"] & 0xFFFF) * block
        x = np.frombuffer(r["sums"], np.float32).reshape(-1, table.shape[1] + 1)
        seen = x[:, 0] > 0
        table[k : k + len(x)][seen] = x[seen, 1:] / x[seen, :1]
    return model


def frequent_words(counts: DataFrame, most: int) -> tuple[list[bytes], np.ndarray]:
    """The words of highest count, at most ``most``, in order; words of one count are taken together or not at all."""
    top = F.least(F.col("c"), F.lit(1 << 20))
    sizes = counts.groupBy(top.alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).collect()  # at most 2^20 counts
    least, held = 1 << 62, 0
    for r in sizes:
        held += r["n"]
        if held > most:
            break
        least = r["c"]
    found = counts.filter(F.col("c") >= least).toArrow()  # at most ``most`` rows
    listed, c = found.column("word").to_pylist(), found.column("c").to_numpy()
    order = sorted(range(len(listed)), key=lambda i: (-c[i], listed[i]))
    return [listed[i] for i in order], c[order]


def coded_texts(rows: DataFrame, held_out: int, head: Callable[[], Head]) -> DataFrame:
    """``row, id, held_out, learn, ids, rare`` of ``rows(id, held_out, part, text)``: the ids, and the words beyond the head with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, seq = head(), TaskContext.get().partitionId() << 40
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                made = [h.encode(words(t.as_py())) for t in batch.column("text")]
                n = batch.num_rows
                ends = np.concatenate([[0], np.cumsum([len(i) for i, _ in made])]).astype(np.int32)
                rare = [list(Counter(r).items()) for _, r in made]
                flat = [x for r in rare for x in r]
                pairs = pa.StructArray.from_arrays([pa.array([w for w, _ in flat], pa.binary()), pa.array([c for _, c in flat], pa.int64())], ["word", "n"])
                rare_ends = np.concatenate([[0], np.cumsum([len(r) for r in rare])]).astype(np.int32)
                columns = [pa.array(np.arange(seq, seq + n)), batch.column("id"), batch.column("held_out"), batch.column("learn")]
                columns += [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([i for i, _ in made]))), pa.ListArray.from_arrays(pa.array(rare_ends), pairs)]
                seq += n
                yield pa.RecordBatch.from_arrays(columns, ["row", "id", "held_out", "learn", "ids", "rare"])

    kinds = "row long, id long, held_out boolean, learn boolean, ids array<int>, rare array<struct<word: binary, n: bigint>>"
    return rows.select("id", "held_out", F.coalesce(F.col("part") != held_out, F.lit(False)).alias("learn"), "text").mapInArrow(run, kinds)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held_out: int = 2, head_size: int = HEAD) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row."""
    spark = docs.sparkSession
    part = F.crc32(F.col(id_col).cast("string")) % modulus
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(part == held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"), part.alias("part"))
    learn = rows.filter(F.col("part") != held_out)
    counts = staged(word_counts(learn.select("text")), "word_counts")
    n_docs = learn.count()
    n_words, n_kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n_all, v_all = n_words + n_docs, n_kinds + (n_docs > 0)
    listed, head_counts = frequent_words(counts, min(head_size, HEAD))
    packed, name = spark.sparkContext.broadcast(listed), uuid.uuid4().hex

    def head() -> Head:
        return worker_state(("head", name), lambda: Head(packed.value))

    def tail_endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros((ENDINGS, 2), np.int64), head().ids
        for batch in batches:
            for word, c in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist(), strict=True):
                if word not in known:
                    total[ending(word)] += (c, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(ENDINGS)), pa.array(total[:, 0]), pa.array(total[:, 1])], ["e", "c", "v"])

    tail = np.zeros((ENDINGS, 2))
    for r in counts.mapInArrow(tail_endings, "e long, c long, v long").groupBy("e").agg(F.sum("c").alias("c"), F.sum("v").alias("v")).collect():  # ENDINGS rows
        tail[r["e"]] = r["c"], r["v"]
    coded = staged(coded_texts(rows, held_out, head), "coded_texts")
    taught = coded.filter("learn")
    model = build_model(Head(listed), head_counts, n_docs, tail, neighbours(taught, head))
    for k in range(ROUNDS):
        model = train_round(taught.filter(F.pmod(F.xxhash64("id"), F.lit(ROUNDS)) == k), model)
    shared = spark.sparkContext.broadcast((model, np.log10(np.concatenate([[n_docs], head_counts]) + 1.0), np.concatenate([[n_docs], head_counts]) > 0))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, base, known = shared.value
        size = len(base)
        for batch in batches:
            out = {k: [] for k in ("n_tokens", "n_known", "base", "score")}
            for ids, starts in _chunks(iter([batch])):
                in_head, near = ids < size, np.minimum(ids, size - 1)
                out["n_tokens"].append(np.diff(np.append(starts, len(ids))))
                out["n_known"].append(np.add.reduceat((in_head & known[near]).astype(np.int64), starts))
                out["base"].append(np.add.reduceat(np.where(in_head, base[near], 0.0), starts))
                out["score"].append(np.add.reduceat(m.log10(ids, starts), starts))
            columns = [batch.column(c) for c in ("row", "id", "held_out")]
            columns += [pa.array(np.concatenate(out[c]) if out[c] else [], kind) for c, kind in (("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "held_out", "n_tokens", "n_known", "base", "score"])

    kinds = "row long, id long, held_out boolean, n_tokens long, n_known long, base double, score double"
    scored = coded.select("row", "id", "held_out", "ids").mapInArrow(score, kinds)
    rare = coded.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    extra = rare.join(counts, "word").groupBy("row").agg(F.sum("n").alias("met"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("gain"))
    none = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.join(extra, "row", "left").select(
        "id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + none("met")).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + none("gain") - F.col("n_tokens") * F.lit(float(np.log10(n_all + v_all + 1)))).alias("base_score"),
        (F.col("score") + none("gain")).alias("score"),
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_texts(docs).withColumnRenamed("id", "doc_id")
