"""Dead letters: micro-batches that a sink refuses are kept, and replayed oldest first once it takes rows again.

The queue is a folder of one sub-folder a batch, below the shared folder of the job: rows as Parquet, and a small
JSON file beside them with the source, the batch and when it failed. A batch is there as soon as its JSON file is, and gone with its folder, so a
crash at any moment leaves it either queued or not, never half; a batch replayed twice is left to the sink's own write mode.

Replay drops what is older than ``days``, goes on after a batch that fails, and gives up for this time after ``give_up`` failures in a row, as the
sink is then down for all.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Apply = Callable[[DataFrame, int], None]


@dataclass
class Replayed:
    written: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)
    expired: list[str] = field(default_factory=list)
    stopped: bool = False


class DeadLetters:
    """The queue of one job below ``folder``; at most ``most`` batches are kept, the oldest go first."""

    def __init__(self, spark: SparkSession, folder: str, most: int = 500, days: float = 3, give_up: int = 5):
        self.spark, self.folder, self.most, self.days, self.give_up = spark, folder.rstrip("/"), most, days, give_up
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def guarded(self, source: str, apply: Apply, now: Callable[[], float]) -> Apply:
        """A foreachBatch body that never fails: what ``apply`` refuses is queued. ``now`` gives seconds since 1970."""

        def run(batch: DataFrame, epoch: int) -> None:
            held = batch.persist()
            try:
                apply(held, epoch)
            except Exception as e:
                self.add(held, source, epoch, now(), f"{type(e).__name__}: {e}")
            finally:
                held.unpersist()

        return run

    def add(self, batch: DataFrame, source: str, epoch: int, at: float, error: str) -> None:
        name = f"{int(at * 1000):015d}-{source}-{epoch}"
        batch.write.mode("overwrite").parquet(f"{self.folder}/{name}/rows")
        self._put(name, {"source": source, "epoch": epoch, "at": at, "attempts": 0, "error": error[:500]})
        for old in self.names()[: -self.most]:
            self._drop(old)

    def names(self) -> list[str]:
        """Queued batches, oldest first."""
        if not self._fs.exists(self._path(self.folder)):
            return []
        found = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder)) if s.isDirectory()]
        return sorted(n for n in found if self._fs.exists(self._path(f"{self.folder}/{n}/letter.json")))

    def letter(self, name: str) -> dict:
        return json.loads(self.spark.read.text(f"{self.folder}/{name}/letter.json").first()[0])

    def table(self) -> DataFrame:
        """``name, source, epoch, at, attempts, error`` of the queue."""
        rows = [(n, x["source"], x["epoch"], float(x["at"]), x["attempts"], x["error"]) for n in self.names() for x in [self.letter(n)]]  # at most ``most``
        return self.spark.createDataFrame(rows, "name string, source string, epoch long, at double, attempts int, error string")

    def replay(self, appliers: dict[str, Apply], now: float) -> Replayed:
        """Each source's batches to its own ``apply`` again."""
        done, in_a_row = Replayed(), 0
        for name in self.names():
            letter = self.letter(name)
            if now - letter["at"] > self.days * 86400:
                self._drop(name)
                done.expired.append(name)
                continue
            try:
                appliers[letter["source"]](self.spark.read.parquet(f"{self.folder}/{name}/rows"), letter["epoch"])
            except Exception as e:
                self._put(name, letter | {"attempts": letter["attempts"] + 1, "error": f"{type(e).__name__}: {e}"[:500]})
                done.failed.append(name)
                in_a_row += 1
                if in_a_row >= self.give_up:
                    done.stopped = True
                    break
                continue
            self._drop(name)
            done.written.append(name)
            in_a_row = 0
        return done

    def _put(self, name: str, letter: dict) -> None:
        out = self._fs.create(self._path(f"{self.folder}/{name}/letter.json"), True)
        try:
            out.write(bytearray(json.dumps(letter, ensure_ascii=False).encode()))
        finally:
            out.close()

    def _drop(self, name: str) -> None:
        # the letter first: rows without one are no batch
        self._fs.delete(self._path(f"{self.folder}/{name}/letter.json"), False)
        self._fs.delete(self._path(f"{self.folder}/{name}"), True)
