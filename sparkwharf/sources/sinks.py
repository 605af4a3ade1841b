"""Sinks: the write modes against stored tables, exports, and ledgers.

A table is a folder of numbered versions, each an ordinary Spark output. A version counts once Spark has
marked it complete and its writer has claimed its number, and the newest such one is the table, so a crash at any point leaves the
last state. A number is claimed by creating a file that must not be there yet: of two writers that began from one version the first wins and the other
gets :class:`Conflict`, with nothing lost. Appends add files to the newest version; merges write the next one and keep the one before for its readers.
Tables by day are better kept with :func:`replace_day`, which rewrites the batch's partitions only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import replace

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwharf.operators import write_modes as wm
from sparkwharf.sources.specs import TableSpec, conform


class Conflict(RuntimeError):
    """Another writer was first; read again and repeat."""


class Store:
    """Tables below a root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, name: str) -> list[str]:
        """The complete versions, oldest first."""
        folder = self._path(f"{self.root}/{name}")
        if not self._fs.exists(folder):
            return []
        all_ = sorted(str(s.getPath().getName()) for s in self._fs.listStatus(folder) if s.isDirectory())
        return [v for v in all_ if self._fs.exists(self._path(f"{self.root}/{name}/{v}/_SUCCESS")) and self._claimant(name, v.split("-")[0]) == v]

    def _claimant(self, name: str, number: str) -> str | None:
        path = self._path(f"{self.root}/{name}/{number}.claim")
        if not self._fs.exists(path):
            return None
        source = self._fs.open(path)
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def _claim(self, name: str, version: str) -> None:
        try:
            out = self._fs.create(self._path(f"{self.root}/{name}/{version.split('-')[0]}.claim"), False)
        except Py4JJavaError as e:
            self._fs.delete(self._path(f"{self.root}/{name}/{version}"), True)
            raise Conflict(f"version {version.split('-')[0]} of {name} is another writer's") from e
        try:
            out.write(bytearray(version.encode()))
        finally:
            out.close()

    def read(self, spec: TableSpec) -> DataFrame:
        found = self.versions(spec.name)
        return self.spark.read.schema(spec.schema).parquet(f"{self.root}/{spec.name}/{found[-1]}") if found else self.spark.createDataFrame([], spec.schema)

    def _next(self, spec: TableSpec, new: DataFrame) -> None:
        found = self.versions(spec.name)
        number = int(found[-1].split("-")[0]) + 1 if found else 0
        version = f"{number:012d}-{uuid.uuid4().hex[:8]}"
        new.write.parquet(f"{self.root}/{spec.name}/{version}")
        self._claim(spec.name, version)
        for old in found[:-1]:
            self._fs.delete(self._path(f"{self.root}/{spec.name}/{old}"), True)

    def write(self, spec: TableSpec, batch: DataFrame) -> None:
        """Apply a batch (with ``_seq`` where the mode needs arrival order) by the table's mode."""
        with_seq = T.StructType([*spec.schema.fields, T.StructField("_seq", T.LongType())])
        rows = conform(batch, replace(spec, schema=with_seq))
        if spec.mode == "append" and (found := self.versions(spec.name)):
            rows.select(spec.schema.names).write.mode("append").parquet(f"{self.root}/{spec.name}/{found[-1]}")
            return
        table = self.read(spec)
        if spec.mode == "append":
            new = rows.select(spec.schema.names)
        elif spec.mode in ("upsert", "current"):
            new = wm.upsert(table, wm.keep_last(rows, list(spec.keys)), list(spec.keys))
        elif spec.mode == "insert_absent":
            new = wm.insert_new(table, rows, list(spec.keys), *[list(k) for k in spec.also_unique])
        else:
            new = wm.replace_days(table, rows.select(spec.schema.names), spec.keys[0])
        self._next(spec, new)

    def prune(self, spec: TableSpec, seen_at: str, batch_time) -> None:
        self._next(spec, wm.prune_stale(self.read(spec), seen_at, batch_time))


def replace_day(batch: DataFrame, path: str, day: str = "day") -> None:
    """Overwrite only the batch's day partitions."""
    batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def publish_run(store: Store, rows_spec: TableSpec, ledger_spec: TableSpec, rows: DataFrame, run: str, expected: int, grain: list[str]) -> bool:
    """Rows first, ledger last; an incomplete or duplicate run leaves a failed ledger entry and no rows."""
    check = wm.completeness(rows.withColumn("run", F.lit(run)), "run", rows.sparkSession.createDataFrame([(run, expected)], "run string, expected int"), grain).first()
    known = store.read(ledger_spec).filter((F.col("run") == run) & F.col("ok")).limit(1).count()
    ok = bool(check["complete"]) and not known
    if ok:
        store.write(rows_spec, rows)
    store.write(ledger_spec, rows.sparkSession.createDataFrame([(run, ok, int(check["n_rows"]))], "run string, ok boolean, n_rows long"))
    return ok


def fan_out(batch: DataFrame, tag: str, targets: dict[str, Callable[[DataFrame], None]]) -> None:
    """Hand each tag's rows to its sink; the batch is read once."""
    held = batch.persist()
    try:
        for name, rows in wm.fan_out(held, tag, list(targets)).items():
            targets[name](rows)
    finally:
        held.unpersist()


def export_json_array(rows: DataFrame, path: str) -> None:
    """Gzipped files of one JSON array each, as many as partitions; rows stream through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = "["
        for batch in batches:
            lines = []
            for row in batch.column(0).to_pylist():
                lines.append(sign + row)
                sign = ","
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if sign == "[" else "]"])], ["value"])

    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).mapInArrow(run, "value string").write.option("compression", "gzip").text(path)


def export_arrow(rows: DataFrame, folder: str) -> DataFrame:
    """Uncompressed Arrow IPC files, one a partition; returns ``file, n`` of the tasks that counted, other files are orphans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, n, writer = TaskContext.get(), 0, None
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        file = f"{root}/part-{context.partitionId():06d}-{context.taskAttemptId()}.arrow"
        with store.open_output_stream(file) as out:
            for batch in batches:
                writer = writer or pa.ipc.new_file(out, batch.schema)
                writer.write_batch(batch)
                n += batch.num_rows
            if writer:
                writer.close()
        yield pa.RecordBatch.from_pydict({"file": [file], "n": pa.array([n], pa.int64())})

    rows.mapInArrow(run, "file string, n long").write.parquet(f"{folder}/_manifest")
    return rows.sparkSession.read.schema("file string, n long").parquet(f"{folder}/_manifest")


def read_arrow(manifest: DataFrame, folder: str, schema: T.StructType | str) -> DataFrame:
    """The rows of the files in a manifest, a task for each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file in batch.column("file").to_pylist():
                with store.open_input_file(file) as src:
                    reader = pa.ipc.open_file(src)
                    for k in range(reader.num_record_batches):
                        yield reader.get_batch(k)

    files = manifest.filter("n > 0").select("file")
    return files.repartitionByRange(max(1, files.count()), "file").mapInArrow(run, schema)


def export_csv(rows: DataFrame, path: str) -> None:
    rows.write.option("compression", "gzip").option("header", True).csv(path)


def export_parquet_uncompressed(rows: DataFrame, path: str) -> None:
    rows.write.option("compression", "uncompressed").parquet(path)


def verified_export(rows: DataFrame, write: Callable[[DataFrame], None], count_back: Callable[[], int]) -> int:
    """Write, count what is there, and fail on none or on another number."""
    from pyspark.sql import Observation

    seen = Observation()
    write(rows.observe(seen, F.count(F.lit(1)).alias("n")))
    n, back = seen.get["n"], count_back()
    if not n or n != back:
        raise RuntimeError(f"wrote {n} rows, found {back}")
    return n
