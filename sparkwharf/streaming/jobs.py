"""Structured Streaming forms: windows, de-duplication, current state, sessions, incidents, timeouts and backoff."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sparkwharf.operators.health import RANK
from sparkwharf.sources.sinks import Store
from sparkwharf.sources.specs import TableSpec


def tumbling(events: DataFrame, minutes: int, *keys: str, late: str = "1 day") -> DataFrame:
    """Counts and sums per window and key; late rows count until the watermark passes."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", f"{minutes} minutes").alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, key: str, gap_seconds: int = 900, late: str = "1 day") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(key, F.session_window("ts", f"{gap_seconds} seconds 1 microsecond").alias("w")).agg(F.count(F.lit(1)).alias("n"))


def deduplicated(events: DataFrame, *keys: str, within: str = "7 days") -> DataFrame:
    """The first row of each key inside the horizon; state is dropped behind it."""
    return events.withWatermark("ts", within).dropDuplicatesWithinWatermark(list(keys))


def into_table(store: Store, spec: TableSpec) -> Callable[[DataFrame, int], None]:
    """A foreachBatch body that applies each micro-batch by the table's write mode.

    A batch that is replayed after a failure gives the same keyed table again.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        store.write(spec, batch)

    return apply


def incident_step(state: tuple | None, level: str, at: str) -> tuple[str, str, tuple | None]:
    """``(event, level, next state)``; state is (level, runs, first seen, last seen).

    A first trouble is new, a higher level worsened, the end recovered, all else
    silent; the third watch in a row counts as critical.
    """
    if RANK[level] == 0:
        return ("recovered" if state else "silent"), "ok", None
    if state is None:
        return "new", level, (level, 1, at, at)
    before, runs, first, _ = state
    raised = "critical" if level == "watch" and runs + 1 >= 3 else level
    if RANK[raised] > RANK[before]:
        return "worsened", raised, (raised, runs + 1, first, at)
    return "silent", raised, (before, runs + 1, first, at)


class _Keyed(StatefulProcessor):
    """Rows of a key in the order of a column, folded over one typed value that is forgotten when its time to live is over."""

    STATE, ORDER = "", "at"

    def __init__(self, ttl_hours: float | None = None):
        self.ttl = None if ttl_hours is None else int(ttl_hours * 3_600_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("value", self.STATE, self.ttl)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(rows).sort_values(self.ORDER, kind="stable")
        now = tuple(self.value.get()) if self.value.exists() else None
        out, then = self.fold(key[0], frame, now)
        if then is not None:
            self.value.update(then)
        elif now is not None:
            self.value.clear()
        yield out

    def fold(self, key, frame: pd.DataFrame, now: tuple | None) -> tuple[pd.DataFrame, tuple | None]:
        raise NotImplementedError

    def close(self) -> None:
        pass


def keyed_state(spark: SparkSession, evolving: bool = False) -> None:
    """Settings that the keyed jobs need: state in RocksDB.

    ``evolving`` encodes it so that later versions of a job may add fields to their state; queries that hold other state (windows,
    sessions) can't run in a session so set.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.encodingFormat", "avro" if evolving else "unsaferow")


def _transformed(rows: DataFrame, key: str, processor: StatefulProcessor, schema: str, mode: str) -> DataFrame:
    if "RocksDB" not in rows.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass", ""):
        raise ValueError("keyed jobs need state in RocksDB: call keyed_state(spark) first")
    return rows.groupBy(key).transformWithStateInPandas(processor, schema, "Append", mode)


class _Incidents(_Keyed):
    STATE = "level string, runs int, first string, last string"

    def fold(self, key, frame, now):
        out = []
        for level, at in frame[["level", "at"]].itertuples(index=False):
            event, shown, now = incident_step(now, level, at)
            out.append((key, at, event, shown))
        return pd.DataFrame(out, columns=["fingerprint", "at", "event", "level"]), now


def incidents(checks: DataFrame, ttl_hours: float = 24 * 30) -> DataFrame:
    """``checks(fingerprint, level, at)`` in order of ``at`` inside each key: one event row per check.

    An incident that no check has touched for ``ttl_hours`` is forgotten, and one that ends leaves no state.
    """
    return _transformed(checks, "fingerprint", _Incidents(ttl_hours), "fingerprint string, at string, event string, level string", "ProcessingTime")


def incidents_batch(checks: DataFrame) -> DataFrame:
    """The same fold over stored checks; one key's checks are one task's."""

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        now, out = None, []
        for key, level, at in frame.sort_values("at")[["fingerprint", "level", "at"]].itertuples(index=False):
            event, shown, now = incident_step(now, level, at)
            out.append((key, at, event, shown))
        return pd.DataFrame(out, columns=["fingerprint", "at", "event", "level"])

    return checks.groupBy("fingerprint").applyInPandas(fold, "fingerprint string, at string, event string, level string")


class _Flights(StatefulProcessor):
    """A flight's first and last time and its rows, until it lands or a timer on event time ends it."""

    def __init__(self, timeout_seconds: int):
        self.timeout = timeout_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.value = handle, handle.getValueState("flight", "first long, last long, n int")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(rows)
        lo, hi = int(frame["epoch"].min()), int(frame["epoch"].max())
        first, last, n = self.value.get() if self.value.exists() else (lo, hi, 0)
        first, last, n = min(first, lo), max(last, hi), n + len(frame)
        for due in list(self.handle.listTimers()):
            self.handle.deleteTimer(due)
        if frame["landed"].fillna(False).any():
            self.value.clear()
            yield self._row(key, first, last, n, "landed")
        else:
            self.value.update((first, last, n))
            self.handle.registerTimer((last + self.timeout) * 1000)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first, last, n = self.value.get()
        self.value.clear()
        yield self._row(key, first, last, n, "timeout")

    def _row(self, key: tuple, *rest) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *rest)], columns=["flight", "first", "last", "n", "how"])

    def close(self) -> None:
        pass


def flights(updates: DataFrame, timeout_minutes: int = 60) -> DataFrame:
    """``updates(flight, at timestamp, landed)``: a row when a flight lands or falls silent for the timeout of event time.

    Times reach the workers as seconds since 1970, so the session's time zone is no matter.
    """
    rows = updates.withColumn("epoch", F.unix_seconds("at")).withWatermark("at", "10 minutes").select("flight", "at", "epoch", "landed")
    return _transformed(rows, "flight", _Flights(timeout_minutes * 60), "flight string, first long, last long, n int, how string", "EventTime")


class _Backoff(_Keyed):
    STATE = "fails int"

    def __init__(self, base: int, most: int, ttl_hours: float):
        super().__init__(ttl_hours)
        self.base, self.most = base, most

    def fold(self, key, frame, now):
        fails, out = now[0] if now else 0, []
        for at, ok in frame[["at", "ok"]].itertuples(index=False):
            fails = 0 if ok else fails + 1
            out.append((key, at, min(self.base * 2 ** min(fails - 1, 40), self.most) if fails else 0))
        return pd.DataFrame(out, columns=["key", "at", "wait"]), (fails,) if fails else None


def backoff(attempts: DataFrame, base_seconds: int = 60, most_seconds: int = 3600, ttl_hours: float = 24) -> DataFrame:
    """``attempts(key, at long, ok)``: seconds to wait after each, doubled by failures in a row, none after success.

    Only failing keys have state, and those not tried for ``ttl_hours`` begin anew.
    """
    return _transformed(attempts, "key", _Backoff(base_seconds, most_seconds, ttl_hours), "key string, at long, wait long", "ProcessingTime")


class _Changed(_Keyed):
    STATE = "digest string"

    def fold(self, key, frame, now):
        last, out = now[0] if now else None, []
        for at, digest in frame[["at", "digest"]].itertuples(index=False):
            if digest != last:
                out.append((key, at, digest))
                last = digest
        return pd.DataFrame(out, columns=["key", "at", "digest"]), (last,)


def changed(snapshots: DataFrame, ttl_hours: float = 24 * 7) -> DataFrame:
    """``snapshots(key, at, digest)``: only those whose digest differs from the key's last; a key not seen for ``ttl_hours`` is new again."""
    return _transformed(snapshots, "key", _Changed(ttl_hours), "key string, at string, digest string", "ProcessingTime")
