from sparkwharf.sources.sinks import Store
from sparkwharf.sources.specs import TableSpec
from sparkwharf.streaming import jobs
from sparkwharf.streaming.dead_letters import DeadLetters

SCHEMA = "k string, v long"


class Sink:
    """A sink that is down at times, or takes some batches only."""

    def __init__(self):
        self.down, self.bad, self.rows, self.seen = False, set(), [], []

    def __call__(self, batch, epoch):
        rows = sorted(map(tuple, batch.collect()))
        self.seen.append(rows)
        if self.down or self.bad & {k for k, _ in rows}:
            raise ConnectionError("no connection")
        self.rows += rows


def queued(spark, path, n, sink, at=0.0, **more):
    letters, sink.down = DeadLetters(spark, str(path), **more), True
    body = letters.guarded("feed", sink, lambda: clock[0])
    clock = [at]
    for i in range(n):
        clock[0] = at + i
        body(spark.createDataFrame([(f"k{i}", i)], SCHEMA), i)
    sink.down, sink.seen = False, []
    return letters


def test_failed_batches_come_again_in_order(spark, tmp_path):
    sink = Sink()
    letters = queued(spark, tmp_path, 3, sink)
    assert [(r["epoch"], r["attempts"], r["error"]) for r in letters.table().collect()] == [(i, 0, "ConnectionError: no connection") for i in range(3)] and not sink.rows
    done = letters.replay({"feed": sink}, 10.0)
    assert [x[0][0] for x in sink.seen] == ["k0", "k1", "k2"] and len(done.written) == 3 and not done.stopped and letters.names() == []
    assert DeadLetters(spark, str(tmp_path / "none")).replay({}, 0.0).written == []


def test_one_bad_batch_doesnt_hold_up_the_others(spark, tmp_path):
    sink = Sink()
    letters, sink.bad = queued(spark, tmp_path, 4, sink), {"k1"}
    done = letters.replay({"feed": sink}, 10.0)
    assert sorted(sink.rows) == [("k0", 0), ("k2", 2), ("k3", 3)] and len(done.failed) == 1
    assert [(r["epoch"], r["attempts"]) for r in letters.table().collect()] == [(1, 1)]


def test_gives_up_after_failures_in_a_row(spark, tmp_path):
    sink = Sink()
    letters = queued(spark, tmp_path, 7, sink, give_up=3)
    sink.bad = {"k0", "k1", "k3", "k4", "k5"}
    done = letters.replay({"feed": sink}, 10.0)
    assert done.stopped and [x[0][0] for x in sink.seen] == [f"k{i}" for i in range(6)] and len(letters.names()) == 6  # k2 went, k6 wasn't tried


def test_old_batches_expire_and_the_oldest_make_room(spark, tmp_path):
    sink = Sink()
    letters = queued(spark, tmp_path, 4, sink, at=1000.0, most=3)
    assert [r["epoch"] for r in letters.table().collect()] == [1, 2, 3]
    done = letters.replay({"feed": sink}, 1002.5 + 3 * 86400)
    assert len(done.expired) == 2 and sink.rows == [("k3", 3)]
    with_no_letter = tmp_path / "000-feed-9" / "rows"
    with_no_letter.mkdir(parents=True)
    assert letters.names() == []


def test_a_stream_goes_on_and_replay_completes_the_table(spark, tmp_path):
    spec = TableSpec("t", spark.createDataFrame([], SCHEMA).schema, ("k",), "upsert")
    store, fail = Store(spark, str(tmp_path / "store")), [True, False, True]
    write = jobs.into_table(store, spec)

    def apply(batch, epoch):
        if fail[epoch]:
            raise TimeoutError("busy")
        write(batch, epoch)

    letters = DeadLetters(spark, str(tmp_path / "dead"))
    for i in range(3):
        spark.createDataFrame([(f"k{i}", i)], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        stream.writeStream.foreachBatch(letters.guarded("t", apply, lambda i=i: float(i))).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
    assert {tuple(r) for r in store.read(spec).collect()} == {("k1", 1)}
    fail[:] = [False] * 3
    assert len(letters.replay({"t": apply}, 5.0).written) == 2
    assert {tuple(r) for r in store.read(spec).collect()} == {("k0", 0), ("k1", 1), ("k2", 2)}
