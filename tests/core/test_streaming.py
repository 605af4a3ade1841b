import random
import time

import pytest
from pyspark.sql import functions as F

from sparkwharf.operators import dedup
from sparkwharf.sources.sinks import Store
from sparkwharf.sources.specs import TableSpec
from sparkwharf.streaming import jobs


@pytest.fixture(autouse=True)
def rocksdb(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass"), spark.conf.get("spark.sql.streaming.stateStore.encodingFormat")
    jobs.keyed_state(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before[0])
    spark.conf.set("spark.sql.streaming.stateStore.encodingFormat", before[1])


def run(stream, name, mode="append"):
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return q


def run_batches(spark, tmp_path, job, batches, schema):
    """Each batch a run of one trigger from the same checkpoint, as jobs with a time to live never run out of triggers by themselves; how many rows there are after each."""
    out, n = str(tmp_path / "out"), []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = job(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(once=True).start(out).awaitTermination(120)
        n.append(spark.read.schema(stream.schema).parquet(out).count())
    return spark.read.schema(stream.schema).parquet(out).collect(), n


def source(spark, tmp_path, batches, schema):
    """One file a batch, in order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/b={i}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))


def test_windows_equal_batch(spark, tmp_path):
    schema = "ts timestamp, key string, value long"
    rows = [(f"2024-01-05 00:{m:02d}:00", "ab"[m % 2], m) for m in range(50)]
    cast = lambda rs: [tuple(r) for r in spark.createDataFrame(rs, "t string, key string, value long").select(F.col("t").cast("timestamp"), "key", "value").collect()]
    sentinel = cast([("2024-01-09 00:00:00", "z", 0)])
    stream = source(spark, tmp_path, [cast(rows[:30]), cast(rows[30:]), sentinel], schema)
    run(jobs.tumbling(stream, 15, "key"), "windows")
    got = {(r.w.start, r.key, r.n, r.total) for r in spark.table("windows").collect() if r.key != "z"}
    batch = spark.createDataFrame(cast(rows), schema).groupBy(F.window("ts", "15 minutes").alias("w"), "key").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    assert got == {(r.w.start, r.key, r.n, r.total) for r in batch.collect()} and got


def test_dedup_and_current_state(spark, tmp_path):
    schema = "ts timestamp, key string, value long, _seq long"
    t = spark.sql("SELECT timestamp'2024-01-05 00:00:00' AS t").first().t
    stream = source(spark, tmp_path, [[(t, "a", 1, 1), (t, "a", 2, 2), (t, "b", 3, 3)], [(t, "a", 9, 4), (t, "c", 4, 5)]], schema)
    run(jobs.deduplicated(stream, "key"), "once")
    assert sorted(r.key for r in spark.table("once").collect()) == ["a", "b", "c"]
    spec = TableSpec("cur", spark.createDataFrame([], "key string, value long").schema, ("key",), "current")
    store = Store(spark, str(tmp_path / "store"))
    q = stream.writeStream.foreachBatch(jobs.into_table(store, spec)).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(120)
    assert {tuple(r) for r in store.read(spec).collect()} == {("a", 9), ("b", 3), ("c", 4)}


CHECKS = [("x", "watch", "1"), ("x", "watch", "2"), ("x", "watch", "3"), ("x", "ok", "4"), ("y", "critical", "1"), ("y", "critical", "2"), ("z", "ok", "1"), ("x", "watch", "5")]


def test_incidents_stream_equals_batch(spark, tmp_path):
    """State lives on from one run to the next."""
    schema = "fingerprint string, level string, at string"
    rows, n = run_batches(spark, tmp_path, jobs.incidents, [CHECKS[:2], CHECKS[2:5], CHECKS[5:]], schema)
    got = sorted(map(tuple, rows))
    assert n == [2, 5, 8]
    assert got == sorted(map(tuple, jobs.incidents_batch(spark.createDataFrame(CHECKS, schema)).collect()))
    assert [g[2] for g in got if g[0] == "x"] == ["new", "silent", "worsened", "recovered", "new"]
    assert [g[2] for g in got if g[0] in "yz"] == ["new", "silent", "silent"]


def test_backoff_and_changes(spark, tmp_path):
    rows, _ = run_batches(spark, tmp_path / "b", lambda s: jobs.backoff(s, 60, 200), [[("k", 1, False), ("k", 2, False)], [("k", 3, False), ("k", 4, True), ("k", 5, False)]], "key string, at long, ok boolean")
    assert [r["wait"] for r in sorted(rows, key=lambda r: r["at"])] == [60, 120, 200, 0, 60]
    rows, _ = run_batches(spark, tmp_path / "c", jobs.changed, [[("k", "1", "a"), ("k", "2", "a")], [("k", "3", "b"), ("k", "4", "b")]], "key string, at string, digest string")
    assert sorted((r["at"], r["digest"]) for r in rows) == [("1", "a"), ("3", "b")]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Taipei"])
def test_flights_land_or_time_out(spark, tmp_path, zone):
    at = lambda s: spark.sql(f"SELECT timestamp'2024-01-05 {s}Z' AS t").first().t
    batches = [[("a", at("00:00:00"), False), ("b", at("00:01:00"), False)], [("a", at("00:30:00"), True), ("d", at("00:20:00"), False)], [("d", at("01:10:00"), False)], [("c", at("05:00:00"), False)], [("c", at("05:01:00"), False)]]
    stream = source(spark, tmp_path, batches, "flight string, at timestamp, landed boolean")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        run(jobs.flights(stream), f"flights_{zone[:3]}")
        start = 1704412800
        assert {(r.flight, r["first"] - start, r["last"] - start, r.n, r.how) for r in spark.table(f"flights_{zone[:3]}").collect()} == {("a", 0, 1800, 2, "landed"), ("b", 60, 60, 1, "timeout"), ("d", 1200, 4200, 2, "timeout")}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("hours, want", [(1 / 3600, [1, 2]), (1.0, [1, 1])])
def test_state_is_forgotten_after_its_time(spark, tmp_path, hours, want):
    def job(stream):
        time.sleep(2)
        return jobs.changed(stream, hours)

    _, n = run_batches(spark, tmp_path, job, [[("k", "1", "same")], [("k", "2", "same")]], "key string, at string, digest string")
    assert n == want


def test_state_takes_another_field(spark, tmp_path, monkeypatch):
    """A job stopped, given one more field of state, and started again from its checkpoint goes on with what it knew."""
    schema = "key string, at string, digest string"
    jobs.keyed_state(spark, evolving=True)

    old, job = jobs._Changed.fold, lambda s: jobs.changed(s, None)
    run_batches(spark, tmp_path, job, [[("k", "1", "a"), ("j", "1", "b")]], schema)
    monkeypatch.setattr(jobs._Changed, "STATE", "digest string, seen int")
    monkeypatch.setattr(jobs._Changed, "fold", lambda self, key, frame, now: (lambda out: (out[0], (*out[1], 1)))(old(self, key, frame, now)))
    rows, n = run_batches(spark, tmp_path, job, [[("k", "2", "a"), ("j", "2", "c")]], schema)
    assert n == [3] and sorted((r["key"], r["at"]) for r in rows) == [("j", "1"), ("j", "2"), ("k", "1")]


def test_keyed_jobs_ask_for_rocksdb(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    with pytest.raises(ValueError, match="keyed_state"):
        jobs.changed(spark.createDataFrame([], "key string, at string, digest string"))


@pytest.mark.parametrize("seed", [1, 2])
def test_greedy_near_duplicates(spark, seed):
    rng = random.Random(seed)
    rows, x = [], 0
    for seq in range(150):
        x = rng.getrandbits(64) if seq % 10 == 0 else x
        y = x
        for _ in range(rng.randint(0, 5)):
            y ^= 1 << rng.randrange(64)
        rows.append((seq, y - (y >> 63 << 64)))
    kept = []
    for seq, s in rows:
        if all(((s ^ k) & (2**64 - 1)).bit_count() > 3 for _, k in kept):
            kept.append((seq, s))
    got = dedup.greedy_keep(spark.createDataFrame(rows, "seq long, sig long")).collect()
    assert sorted(map(tuple, got)) == kept
