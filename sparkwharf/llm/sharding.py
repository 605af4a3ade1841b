"""Operator 12: shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` points on a ring of 60-bit positions, every row one position, from its
key. Rows are taken in the order of their positions; each goes to the first shard clockwise that
isn't full. Shards hold ``ceil((1 + slack) * rows / shards)`` rows at most; with ``slack`` 0 the first
``rows mod shards`` shards hold one row more than the others and all are filled, so counts are at most one apart.

All rows between two points see the shards in the same order, so how a shard overflows depends on how many
rows lie in each arc only. Those counts (one for each virtual node, whatever the number of rows) are brought to the driver,
which lays out segments of the ring order; a row's rank in that order gives its shard and its place there.
Ranks come from one range partitioning of the slim rows, written to the shared folder: a row's number in its file plus
the rows of the files before. Rows of equal position are told apart by the file and row they were staged at,
so no key, however often repeated, lands in one task.

When a shard is added, positions and points stay where they are: a row moves only if the new shard takes it
or if segments shift because limits did (:func:`movement` counts both).

Cases: null ids and texts are keys like any other; rows that repeat all columns are placed one by one; an empty
table gives an empty result; other columns are carried, but ``_position``, ``_shard`` and ``_slot`` may not be there already.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwharf.llm.common import staged, staging_path, with_fields

SHARDS, VNODES = 16, 64
#: Virtual nodes of all shards together; what the driver and each task hold of the ring grows with these.
MAX_POINTS = 1 << 20


def ring_position(key: str) -> int:
    """The first 15 hexadecimal digits of the key's MD5."""
    return int(hashlib.md5(key.encode()).hexdigest()[:15], 16)


def position_of(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def ring(shards: int, vnodes: int) -> tuple[list[int], list[int]]:
    """Points in order, and whose they are."""
    if not 0 < shards * vnodes <= MAX_POINTS:
        raise ValueError(f"{shards} shards of {vnodes} points: 1 to {MAX_POINTS} points can be held")
    points = sorted((ring_position(f"{s}:{v}"), s) for s in range(shards) for v in range(vnodes))
    return [p for p, _ in points], [s for _, s in points]


def limits(rows: int, shards: int, slack: float) -> list[int]:
    if slack < 0:
        raise ValueError("slack is 0 or more")
    if not slack:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [-(-rows * int(1e6 * (1 + slack)) // (shards * 1_000_000))] * shards


def segments(arcs: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int]]:
    """``(first rank, shard, first slot)`` of runs in ring order, where ``arcs`` counts the rows before each point (the last: those after all points).

    Each arc's rows fill its owner, then the next shards clockwise that have room.
    """
    room, taken, out, rank = list(room), [0] * len(room), [], 0
    for arc, rows in enumerate(arcs):
        at = arc
        while rows:
            s = owners[at % len(owners)]
            n = min(rows, room[s])
            if n:
                out.append((rank, s, taken[s]))
                room[s], taken[s], rank, rows = room[s] - n, taken[s] + n, rank + n, rows - n
            at += 1
    return out


def _ranged(docs: DataFrame, key: Column) -> DataFrame:
    """``docs`` with ``_position``, written in ring order: the files' names and the rows' places in them give the order."""
    if taken := {"_position", "_shard", "_slot", "_file", "_i", "_part"} & set(docs.columns):
        raise ValueError(f"columns {sorted(taken)} are there already")
    spark = docs.sparkSession
    first = staged(docs.withColumn("_position", position_of(key)), "ring_rows")
    named = first.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_i"))
    order = ["_position", "_file", "_i"]
    ordered = named.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).drop("_file", "_i")
    path = staging_path(spark, "ring_order")
    ordered.write.option("maxRecordsPerFile", 0).parquet(path)  # one file a partition, whose rows keep their order
    return spark.read.schema(ordered.schema).parquet(path).select("*", F.col("_metadata.row_index").alias("_i"))


def _arcs(ranged: DataFrame, points: list[int]) -> tuple[list[int], dict[int, int]]:
    """Rows of each arc; the rank of each part's first row."""
    shared = ranged.sparkSession.sparkContext.broadcast(np.array(points))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a row at a point is that point's
            at = np.searchsorted(shared.value, batch.column("_position").to_numpy(), "left")
            arc, n = np.unique(at, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(arc, pa.int64()), pa.array(n, pa.int64())], ["arc", "n"])

    arcs, parts = [0] * (len(points) + 1), {}
    for r in ranged.select("_position").mapInArrow(count, "arc long, n long").groupBy("arc").agg(F.sum("n").alias("n")).collect():  # a row a point
        arcs[r["arc"]] = r["n"]
    rank = 0
    for r in ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect():  # a row a partition
        parts[r["_part"]], rank = rank, rank + r["n"]
    return arcs, parts


def _layout(ranged: DataFrame, shards: int, vnodes: int, slack: float) -> tuple[list[tuple[int, int, int]], dict[int, int]]:
    points, owners = ring(shards, vnodes)
    arcs, parts = _arcs(ranged, points)
    return segments(arcs, owners, limits(sum(arcs), shards, slack)), parts


def _place(ranged: DataFrame, parts: dict[int, int], layouts: list[tuple[str, str, list]]) -> DataFrame:
    """``ranged`` with a shard and a slot column for each layout."""
    tables = [np.array(runs, np.int64).reshape(-1, 3).T for _, _, runs in layouts]
    shared = ranged.sparkSession.sparkContext.broadcast((tables, parts))
    added = {c: t for shard_col, slot_col, _ in layouts for c, t in ((shard_col, "int"), (slot_col, "long"))}
    schema = T.StructType([f for f in with_fields(ranged, **added).fields if f.name not in ("_i", "_part")])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, before = shared.value
        for batch in batches:
            whole, inverse = np.unique(batch.column("_part").to_numpy(), return_inverse=True)
            rank = np.array([before[p] for p in whole.tolist()], np.int64)[inverse] + batch.column("_i").to_numpy()
            columns = [batch.column(n) for n in batch.schema.names if n not in ("_i", "_part")]
            for first, shard, slot in tables:
                at = np.searchsorted(first, rank, "right") - 1
                columns += [pa.array(shard[at].astype(np.int32)), pa.array(slot[at] + rank - first[at])]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return ranged.mapInArrow(place, schema)


def assign(docs: DataFrame, key: Column, shards: int = SHARDS, vnodes: int = VNODES, slack: float = 0.0) -> DataFrame:
    """``docs`` with ``_position``, ``_shard`` (from 0) and ``_slot`` (from 0 in each shard, without gaps, in ring order)."""
    ranged = _ranged(docs, key)
    runs, parts = _layout(ranged, shards, vnodes, slack)
    return _place(ranged, parts, [("_shard", "_slot", runs)])


def movement(docs: DataFrame, key: Column, shards: int = SHARDS, vnodes: int = VNODES, slack: float = 0.0) -> DataFrame:
    """How many rows are where when one shard is added: ``_shard, _grown, n``, at most (shards + 1) squared rows."""
    ranged = _ranged(docs.select(key.alias("_key")), F.col("_key"))
    now, parts = _layout(ranged, shards, vnodes, slack)
    then, _ = _layout(ranged, shards + 1, vnodes, slack)
    placed = _place(ranged, parts, [("_shard", "_slot", now), ("_grown", "_place", then)])
    return placed.groupBy("_shard", "_grown").agg(F.count(F.lit(1)).alias("n"))


def write_shards(placed: DataFrame, path: str) -> None:
    """The rows in one folder a shard, ``_shard=0`` and so on, in files of consecutive slots.

    Rows are dealt by ranges of shard and slot, so a shard is written by as many tasks as it needs.
    """
    placed.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot").write.partitionBy("_shard").parquet(path)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 16 shards whose counts are at most one apart."""
    text = F.coalesce("text", F.lit(""))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.md5(F.encode(text, "UTF-8")).alias("digest"))
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest")
    placed = assign(docs, key)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


#: The law row by row: each takes the first shard clockwise that has room. CRC-32 is written out, as SQL has none.
OP12_SQL = """
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i::UBIGINT, 0, i::UBIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END FROM bits WHERE k < 8
), crcs AS (SELECT list(c ORDER BY i) AS l FROM bits WHERE k = 8),
hexed AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS bytes FROM documents),
d AS (
  SELECT rid, doc_id, len(bytes) + 1 AS size, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(text)), 1, 15))::BIGINT AS pos,
  xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(bytes, lambda b: ('0x' || b)::UBIGINT)), lambda a, b: xor(a >> 8, crcs.l[(xor(a, b) & 255)::BIGINT + 1])))::BIGINT AS crc
  FROM hexed, crcs
), points AS (SELECT ('0x' || substr(md5(s || ':' || v), 1, 15))::BIGINT AS pos, s::INT AS s FROM range(16) a(s), range(64) b(v)),
ring AS (SELECT pos, s, row_number() OVER (ORDER BY pos, s) - 1 AS i FROM points),
walk AS (  -- for each point the shards in the order in which they come clockwise
  SELECT i, list(s ORDER BY least) AS shards FROM (SELECT a.i, b.s, min((b.i - a.i + 1024) % 1024) AS least FROM ring a, ring b GROUP BY 1, 2) GROUP BY i
), placed AS (
  SELECT row_number() OVER (ORDER BY d.pos, d.rid) AS n, d.*, walk.shards
  FROM d JOIN (SELECT rid, (SELECT count(*) FROM ring WHERE ring.pos < d.pos) % 1024 AS i FROM d) a USING (rid) JOIN walk USING (i)
), lim AS (SELECT list(n // 16 + CASE WHEN s < n % 16 THEN 1 ELSE 0 END ORDER BY s) AS l FROM (SELECT count(*) AS n FROM d), range(16) r(s)),
fill(n, taken, shard, slot) AS (
  SELECT 0::BIGINT, list_transform(range(16), lambda x: 0::BIGINT), NULL::INT, NULL::BIGINT
  UNION ALL
  SELECT p.n, list_transform(f.taken, lambda x, j: CASE WHEN j = p.s + 1 THEN x + 1 ELSE x END), p.s, f.taken[p.s + 1]
  FROM fill f, LATERAL (SELECT placed.n, list_filter(placed.shards, lambda s: f.taken[s + 1] < lim.l[s + 1])[1] AS s FROM placed, lim WHERE placed.n = f.n + 1) p
)
SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'rows' AS law, shard, slot, NULL::INT AS grown_shard FROM placed JOIN fill USING (n)
"""
