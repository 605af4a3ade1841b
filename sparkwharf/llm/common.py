"""Helpers shared by the training-data operators: staging, hot keys, components."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Upper bound on the rows of any table of heavy keys that is broadcast.
MAX_HEAVY_KEYS = 2000


class Memo(dict):
    """Results of a pure function of short texts, held within ``LIMIT`` bytes of keys and values.

    Two generations: what is met goes to the young one; when that has its half, it becomes the
    old one, so texts that are met often stay and others go.
    """

    LIMIT, LONGEST = 24 << 20, 64

    def __init__(self, make: Callable):
        super().__init__()
        self.make, self.old, self.held = make, {}, 0

    def __missing__(self, key: str):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        self.keep(key, found)
        return found

    def keep(self, key: str, found) -> None:
        if len(key) <= self.LONGEST:
            # a dictionary slot is about 80 bytes, a number in a tuple 32; all empty tuples are one
            self.held += 80 + sys.getsizeof(key) + (sys.getsizeof(found) + (32 * len(found) if isinstance(found, tuple) else 0) if found != () else 0)
            if self.held > self.LIMIT // 2:
                self.old, self.held = dict(self), 0
                self.clear()
            self[key] = found

    def known(self, keys: set[str], make: Callable[[list[str]], list]) -> dict:
        """The results of all keys, those that are missing made together."""
        young = self.keys() & keys
        out = dict(zip(young, map(self.__getitem__, young), strict=True))
        rest = keys - young
        again = self.old.keys() & rest
        fresh = dict(zip(again, map(self.old.__getitem__, again), strict=True))
        missing = list(rest - again)
        fresh.update(zip(missing, make(missing), strict=True))
        out.update(fresh)
        fresh = {k: v for k, v in fresh.items() if len(k) <= self.LONGEST}
        self.held += 80 * len(fresh) + sum(map(sys.getsizeof, fresh)) + sum(sys.getsizeof(v) + 32 * len(v) for v in filter(None, fresh.values()))
        self.update(fresh)
        if self.held > self.LIMIT // 2:
            self.old, self.held = dict(self), 0
            self.clear()
        return out

    def of(self, keys: Iterable[str]) -> Iterator:
        """No result may be None."""
        return map(self.__getitem__, keys)


_LIVE: dict[tuple, object] = {}


def worker_state(name: tuple, build: Callable[[], object]):
    """What one function keeps in this worker: a vocabulary, an index, a memo. Stages share workers, and a worker keeps one state only."""
    if name not in _LIVE:
        for other in _LIVE.values():
            memo = getattr(other, "memo", other)
            if isinstance(memo, Memo):  # its function may refer to it, so it is emptied, not left to the garbage collector
                memo.clear()
                memo.old.clear()
        _LIVE.clear()
        pa.default_memory_pool().release_unused()
        _LIVE[name] = build()
    return _LIVE[name]


def worker_memo(name: tuple, build: Callable[[], Callable]) -> Memo:
    return worker_state(name, lambda: Memo(build()))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where the session names none, a folder beside the warehouse serves a local
    master (tests, a laptop); a cluster must name one, as its machines may not share that.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"


_SCOPES: list[list[str]] = []


def staging_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/sparkwharf/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession):
    """What is staged inside the block is deleted when it ends; its results must be written elsewhere by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            delete(spark, path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    The files are replicated by the shared store, so losing an executor costs a
    reread and no recomputation.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a table made by :func:`staged` once nothing reads it."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete(df.sparkSession, folder)


def first_by_hash(rows: DataFrame, on: list[str], n: int, total: int) -> DataFrame:
    """At most ``n`` of ``total`` rows: those of the smallest hash of ``on``.

    A share of the hash range that holds about n rows is kept first, so no task sorts more than its part of those.
    """
    at = F.pmod(F.xxhash64(*on), F.lit(1 << 30))
    share = min(1.0, (1.1 * n + 1000) / max(1, total))
    return rows.withColumn("_at", at).filter(F.col("_at") <= int(share * (1 << 30))).orderBy("_at", *on).limit(n).drop("_at")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many marks behind it as no column of ``df`` has."""
    out = []
    for name in names:
        while name in df.columns:
            name += "_"
        out.append(name)
    return out


def with_fields(df: DataFrame, **added: str) -> T.StructType:
    """The schema of ``df`` with fields added."""
    if taken := added.keys() & set(df.columns):
        raise ValueError(f"columns {sorted(taken)} are there already")
    return T.StructType([*df.schema.fields, *T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in added.items())).fields])


def join_unique(big: DataFrame, small: DataFrame, key: str, n_rows: int) -> DataFrame:
    """``big`` inner-joined with ``small`` on ``key``, safe against hot keys.

    ``small`` holds each key once, with a column ``n``: how many rows of
    ``big`` carry the key. Keys with at least ``n_rows / MAX_HEAVY_KEYS`` rows
    are at most MAX_HEAVY_KEYS many, so that part of ``small`` is broadcast and
    their rows are never shuffled; all other keys meet in an ordinary join.
    """
    least = max(2, n_rows // MAX_HEAVY_KEYS + 1)
    heavy = small.filter(F.col("n") >= least).drop("n")
    light = small.filter(F.col("n") < least).drop("n")
    hot = big.join(F.broadcast(heavy), key)
    rest = big.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key)
    return hot.unionByName(rest)


def _edge_sum(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
    return row[0], row[1] or 0


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of the undirected links ``edges(a, b)`` as ``(node, root)``.

    ``root`` is the smallest node of the component; only nodes that have a link
    to another node appear. Alternates large-star and small-star steps (Kiveris
    et al., "Connected Components in MapReduce and Beyond") until the links no
    longer change. Every step is a grouped minimum, combined before its
    shuffle, and a join that adaptive execution may split; each round is
    written to the shared folder, so lineage stays short.
    """
    a, b = F.col("a"), F.col("b")
    now = staged(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter(a != b).distinct(),
        "links",
    )
    before = _edge_sum(now)
    for _ in range(max_rounds if before[0] else 0):
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter(b > a).join(low, "a").select(b.alias("a"), F.col("m").alias("b")).filter(a != b).distinct()
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(small_low, "a")
            .select(F.explode(F.array(F.struct(a.alias("a"), F.col("m").alias("b")), F.struct(b.alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*")
            .filter(a != b)
            .distinct()
        )
        after_df = staged(small, "links")
        after = _edge_sum(after_df)
        discard(now)
        now = after_df
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(a.alias("node"), b.alias("root"))
    return roots.unionByName(now.select(b.alias("node"), b.alias("root")).distinct())


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all else untouched."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
