"""SimHash near-dedup by verified similarity: documents whose sets of five-word shingles have Jaccard similarity 0.8 or more.

Candidates come from operator 9 first: 64-bit fingerprints of the five-word shingles, linked by covering
masks within ``RADIUS`` bits. At the similarity of 0.8 fingerprints differ in about ten bits,
which no covering of 64 bits reaches at a useful cost (on sf0.1, 1 of 48 near pairs lies within 2 bits), so
candidates of prefix filtering join them (Chaudhuri et al., "A Primitive Operator for
Similarity Joins"): the shingles of all texts are put in one order, and each text
of n shingles hands out its first n - ceil(0.8 n) + 1. Two texts of similarity 0.8
share one of these with certainty, whatever the order, so no pair is missed. The
order is a matter of speed only: shingles that are common in a sample come last.

Texts of one shingle set are folded first. Texts that share a key are then verified
against the smallest of them, and where a key is still shared by many sets of different components, against
sets drawn anew; what this leaves in different components is paired in
full, so a group of m copies costs m comparisons a key, and no
bucket is capped. Only pairs that share enough of their prefixes to reach the similarity are verified, and only those whose
parity marks are near enough: each shingle flips one of MARKS bits, so the marks of two sets differ in at most as many bits as
the sets differ in shingles, and a pair whose marks differ in more than the similarity allows is none. A text is compared by its whole set of 64-bit shingle hashes.

Cases: texts of fewer than five words are one shingle; null and empty texts have
none and are copies of one another; null ids come last; repeated rows count once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwharf.llm.common import connected_components, free_names, join_unique, staged
from sparkwharf.llm.simhash import BITS, BLOCK, fingerprint_links

SHINGLE, RADIUS = 5, 2
#: Sets compared with one copy of another, and shingles in a batch of sets on their way.
SALTED, SENT = 1000, 1 << 19
#: Rounds of stars at most, and the pairs for each row of shared keys beyond which there is another.
MOST_ROUNDS, DENSE = 3, 4
#: Bits of a set's parity marks, in words of 64.
MARKS = 512
#: Texts sampled for the order of shingles, how many of them make a shingle common, and the most that are broadcast.
SAMPLE, COMMON, MOST_COMMON = 10_000, 4, 1 << 16
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted set of shingle hashes of ASCII lower-cased words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.int64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64).view(np.int64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(h) - size + 1
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = (out ^ h[i : i + n]) * _ODD[i]
        out ^= out >> np.uint64(29)
    return np.unique(out.view(np.int64))


def prefix(grams: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first n - ceil(0.8 n) + 1 of a sorted set, shingles in ``common`` (sorted) last by their ``rank``."""
    n = len(grams)
    least = n - -(-4 * n // 5) + 1 if n else 0
    if not len(common):
        return grams[:least]
    at = np.minimum(np.searchsorted(common, grams), len(common) - 1)
    return grams[np.lexsort((grams, np.where(common[at] == grams, rank[at], 0)))[:least]]


def _common(docs: DataFrame, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of at least COMMON sampled texts, sorted, and in how many they are."""
    every = max(1, docs.count() // SAMPLE)
    text = F.col(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column("text"):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(t.as_py()))], ["h"])

    sample = docs.filter(F.pmod(F.xxhash64(text), F.lit(every)) == 0).select(text.alias("text")).distinct()
    found = sample.mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= COMMON)
    top = found.orderBy(F.desc("c"), "h").limit(MOST_COMMON).toArrow()  # at most MOST_COMMON rows
    h, c = top.column("h").to_numpy(), top.column("c").to_numpy()
    order = np.argsort(h)
    return h[order].astype(np.int64), c[order].astype(np.int64)


def fingerprint(grams: np.ndarray) -> int:
    """The bits that more than half of the set's hashes have, as a signed number."""
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(grams), BLOCK):
        ones += np.unpackbits(grams[k : k + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(grams), bitorder="little").view("<i8")[0])


def marks(grams: np.ndarray) -> np.ndarray:
    """For each of MARKS classes of shingle hashes, whether the set has an odd number of them, packed in words of 64 bits."""
    odd = np.bincount((grams.view(np.uint64) >> np.uint64(33)).astype(np.int64) % MARKS, minlength=MARKS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _node(grams: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(grams.tobytes(), 7) - (1 << 63)


def _sets(rows: DataFrame, pick: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``id, f, node, n, fp, marks, grams`` of ``rows(id, f, text)``: name, size, fingerprint and parity marks of the shingle set, and what ``pick`` takes of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                of = [shingles(t.as_py()) for t in part.column("text")]
                picked = [pick(g) for g in of]
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(g) for g in picked])]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(picked)))
                odd = pa.ListArray.from_arrays(pa.array(np.arange(len(of) + 1, dtype=np.int32) * (MARKS // 64)), pa.array(np.concatenate([marks(g) for g in of])))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("f"), pa.array(map(_node, of), pa.int64()), pa.array([len(g) for g in of], pa.int32()), pa.array(map(fingerprint, of), pa.int64()), odd, lists], ["id", "f", "node", "n", "fp", "marks", "grams"])

    return rows.mapInArrow(run, "id long, f long, node long, n int, fp long, marks array<long>, grams array<long>")


def _verified(pairs: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of sets that have similarity 0.8 or more.

    Each set travels once to every ``b`` it is compared with, where it streams past the set of
    ``b``; the partners of a frequent ``b`` are dealt out over salts of about SALTED, each with a copy of b's set.
    """
    pairs = staged(pairs, "copy_candidates")
    often = staged(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / SALTED).alias("salts")), "copy_partners")
    salted = join_unique(pairs, often, "b", pairs.count())
    sent = salted.select(F.col("a").alias("node"), "b", F.pmod(F.xxhash64("a"), F.col("salts")).alias("salt"), F.lit(False).alias("first"))
    firsts = often.select(F.col("b").alias("node"), "b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(True).alias("first"))
    to = sent.unionByName(firsts).groupBy("node").agg(F.collect_list(F.struct("b", "salt", "first")).alias("to"))
    # one row of each set; others of the same text are left where they are. Where this table is small, Spark broadcasts it and no text moves
    to = staged(to.join(classes.select("node", F.col("w.id").alias("_id"), F.col("w.f").alias("_f")), "node"), "copy_deliveries")
    texts = rows.join(to, (F.col("f") == F.col("_f")) & F.col("id").eqNullSafe(F.col("_id"))).select("node", "to", "text")
    kind = pa.schema([("b", pa.int64()), ("salt", pa.int64()), ("first", pa.bool_()), ("node", pa.int64()), ("grams", pa.list_(pa.int64()))])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def batch_of() -> pa.RecordBatch:
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(g) for *_, g in held])]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([g for *_, g in held])))
            return pa.RecordBatch.from_arrays([*(pa.array([h[i] for h in held], kind.field(i).type) for i in range(4)), lists], schema=kind)

        for batch in batches:
            for node, to, text in zip(batch.column("node").to_pylist(), batch.column("to"), batch.column("text"), strict=True):
                grams = shingles(text.as_py())
                for t in to.as_py():
                    held.append((t["b"], t["salt"], t["first"], node, grams))
                    size += len(grams) + 16
                    if size > SENT:
                        yield batch_of()
                        held, size = [], 0
        if held:
            yield batch_of()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = None
        for batch in batches:
            lists, found = batch.column("grams"), []
            values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            for k, (b_, first, node) in enumerate(zip(batch.column("b").to_pylist(), batch.column("first").to_pylist(), batch.column("node").to_pylist(), strict=True)):
                grams = values[offsets[k] : offsets[k + 1]]
                if first:
                    base = grams
                elif len(np.intersect1d(base, grams, assume_unique=True)) * 9 >= (len(base) + len(grams)) * 4:
                    found.append((node, b_))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    met = texts.mapInArrow(send, "b long, salt long, first boolean, node long, grams array<long>").repartition("b", "salt").sortWithinPartitions("b", "salt", F.desc("first"))
    return staged(met.mapInArrow(compare, "a long, b long").distinct(), "copy_links")


def _like(n: Column, m: Column) -> Column:
    return (n * 5 >= m * 4) & (m * 5 >= n * 4)


def _near(n: Column, m: Column, x: Column, y: Column) -> Column:
    """Whether sets of n and m shingles with parity marks x and y can be similar: they may differ in n + m - 2 ceil(4 (n + m) / 9) shingles."""
    apart = sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(MARKS // 64)), F.lit(0))
    return _like(n, m) & (apart <= n + m - F.floor(((n + m) * 4 + 8) / 9) * 2)


def _fit(n: Column, m: Column, shared: Column) -> Column:
    """Whether sets of n and m shingles whose prefixes have ``shared`` keys in common can be similar.

    Beyond the prefix that ends first in the order, at most the rest of that set can be shared: ceil(0.8 n) - 1 shingles.
    """
    up = lambda x, d: F.floor((x + (d - 1)) / d)
    return _like(n, m) & (shared + F.greatest(up(n * 4, 5), up(m * 4, 5)) - 1 >= up((n + m) * 4, 9))


def fingerprint_pairs(classes: DataFrame) -> DataFrame:
    """Candidates ``a, b``: every set with the smallest one of its component of fingerprints that the covering masks link."""
    fps = staged(classes.groupBy("fp").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("n")), "copy_fingerprints")
    roots = connected_components(fingerprint_links(fps.select("fp"), RADIUS)).withColumnRenamed("node", "fp")
    rooted = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("b"))
    of = staged(rooted.join(lows, "root").select("fp", "b", "n"), "copy_fingerprint_roots")
    return join_unique(classes.select("fp", "node"), of, "fp", classes.count()).filter("node <> b").select(F.col("node").alias("a"), "b")


def copy_links(rows: DataFrame, classes: DataFrame, keyed: DataFrame) -> DataFrame:
    """True links ``a, b`` between sets, with the components of all pairs; ``keyed(key, node)`` are the prefixes."""
    key, size, whole = Window.partitionBy("key"), classes.select("node", "n"), classes.select("node", "n", "marks")
    near = _near(F.col("na"), F.col("nb"), F.col("xa"), F.col("xb"))
    met = keyed.withColumn("low", F.min("node").over(key)).withColumn("high", F.max("node").over(key)).filter("low <> high")
    met = staged(met.select("key", "node", "low"), "copy_keys")
    shared = F.count(F.lit(1)).alias("shared")
    # keys with another smallest set aren't counted here, so the bound is taken at half; pairs it misses come below
    star = met.filter("node <> low").groupBy(F.col("node").alias("a"), F.col("low").alias("b")).agg(shared)
    star = star.join(size.toDF("a", "na"), "a").join(size.toDF("b", "nb"), "b").filter(_fit(F.col("na"), F.col("nb"), F.col("shared") * 2)).select("a", "b")
    star = star.join(whole.toDF("a", "na", "xa"), "a").join(whole.toDF("b", "nb", "xb"), "b").filter(near).select("a", "b")
    links = _verified(star.union(fingerprint_pairs(classes)).distinct(), rows, classes)
    for turn in range(MOST_ROUNDS):
        roots = staged(connected_components(links), "copy_roots")
        placed = met.join(roots, "node", "left").join(size, "node").select("key", "node", "n", F.coalesce("root", "node").alias("root"))
        ends = placed.withColumns({"least": F.min("root").over(key), "most": F.max("root").over(key), "c": F.count(F.lit(1)).over(key)})
        apart = staged(ends.filter("least <> most").drop("least", "most").join(whole.drop("n"), "node"), "copy_keys_apart")
        # what all pairs of different components would come to, at most, and the rows they come from
        pairs, n = apart.agg(F.coalesce(F.sum((F.col("c") - 1) / 2), F.lit(0.0)), F.count(F.lit(1))).first()
        if pairs <= DENSE * n:
            break
        # dense keys: other stars, each around a set drawn anew, which is likely one of the largest group, join groups before pairs are formed
        drawn = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "root", "node", "n", "marks")).over(key)
        dense = apart.filter(F.col("c") > 8 * DENSE).withColumn("base", drawn).filter(F.col("root") != F.col("base.root"))
        more = dense.select(F.col("node").alias("a"), F.col("base.node").alias("b"), F.col("n").alias("na"), F.col("base.n").alias("nb"), F.col("marks").alias("xa"), F.col("base.marks").alias("xb"))
        # dense keys are but some of those that two sets share, so only sizes and marks are tried here
        more = more.filter(near).select("a", "b").distinct()
        links = staged(links.union(_verified(more, rows, classes)).distinct(), "copy_links_so_far")
    roots = staged(connected_components(links), "copy_roots")
    apart = apart.select("key", "node", "n", "marks").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    x, y = apart.withColumnsRenamed({"node": "a", "n": "na", "root": "ra", "marks": "xa"}), apart.withColumnsRenamed({"node": "b", "n": "nb", "root": "rb", "marks": "xb"})
    # pairs are tried in the join itself, so those that can't be similar are never shuffled
    rest = x.join(y, (x["key"] == y["key"]) & (F.col("a") > F.col("b")) & (F.col("ra") != F.col("rb")) & near).groupBy("a", "b", "na", "nb").agg(shared)
    rest = rest.filter(_fit(F.col("na"), F.col("nb"), F.col("shared"))).select("a", "b")
    return links.union(_verified(rest, rows, classes))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component of near copies: the one of the smallest id, nulls last."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("f"), F.col(text_col).alias("text"))
    common, rank = _common(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast((common, rank))
    sets = staged(_sets(rows, lambda g: prefix(g, *shared.value)), "copy_prefixes")
    smallest = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "f"))
    classes = staged(sets.groupBy("node").agg(smallest.alias("w"), F.min("n").alias("n"), F.min("fp").alias("fp"), F.min("marks").alias("marks")), "copy_classes")
    of = classes.select(F.col("node").alias("_node"), F.col("w.id").alias("_id"), F.col("w.f").alias("_f"))
    one = sets.join(of, (F.col("node") == F.col("_node")) & (F.col("f") == F.col("_f")) & F.col("id").eqNullSafe(F.col("_id")), "left_semi")
    links = copy_links(rows, classes, one.select(F.explode("grams").alias("key"), "node"))
    roots = connected_components(links)
    rooted = classes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("w").alias("w"))
    # only rows that repeat both id and text have to meet to become one
    often = sets.groupBy("id", "f").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(F.col("id").alias("_id2"), F.col("f").alias("_f2"), "rows")
    id_, f_, own, times = free_names(docs, "_id", "_f", "_f0", "rows")
    winners = rooted.select(F.col("w.id").alias("_id"), F.col("w.f").alias("_f")).join(often, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_f") == F.col("_f2")), "left")
    winners = staged(winners.select(F.col("_id").alias(id_), F.col("_f").alias(f_), F.col("rows").alias(times)), "copy_winners")
    of_text = docs.withColumn(own, F.xxhash64(F.col(text_col)))
    same = F.col(id_col).eqNullSafe(F.col(id_)) & (F.col(own) == F.col(f_))
    kept = of_text.join(winners.filter(F.col(times).isNull()), same, "left_semi")
    return kept.union(of_text.join(winners.filter(F.col(times) > 1), same, "left_semi").dropDuplicates([id_col, own])).select(docs.columns)
