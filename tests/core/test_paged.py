import json

import pytest

from sparkwharf.sources import paged

FETCH = {"fetch": "sparkwharf.sources.paged.stored_page", "upto": "sparkwharf.sources.paged.stored_count", "pagesize": "10"}


def store(tmp_path, key, first, rows):
    at = tmp_path / f"pages/key={key}/from={first}"
    at.mkdir(parents=True)
    (at / "part.json").write_text("\n".join(json.dumps({"v": v}) for v in rows))


def stream(spark, tmp_path, keys, **more):
    spark.dataSource.register(paged.PagedSource)
    return spark.readStream.format("paged").options(keys=json.dumps(keys), folder=str(tmp_path / "pages"), **FETCH, **more).load()


def go(rows, tmp_path, body):
    q = rows.writeStream.foreachBatch(body).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)


def test_nothing_is_lost_or_repeated_when_a_batch_fails(spark, tmp_path):
    store(tmp_path, "a", 0, range(25))
    store(tmp_path, "b", 0, range(100, 107))
    seen, calls = [], []

    def body(batch, epoch):
        rows = sorted(json.loads(r["row"])["v"] for r in batch.collect())
        calls.append((epoch, rows))
        if len(calls) == 1:
            raise RuntimeError("killed")
        seen.extend(rows)

    with pytest.raises(Exception, match="killed"):
        go(stream(spark, tmp_path, ["a", "b"]), tmp_path, body)
    store(tmp_path, "a", 25, range(25, 40))  # more arrives while it is down
    go(stream(spark, tmp_path, ["a", "b"]), tmp_path, body)
    assert calls[1] == calls[0]  # the failed batch again, with the same pages
    go(stream(spark, tmp_path, ["a", "b"]), tmp_path, body)
    assert sorted(seen) == [*range(40), *range(100, 107)]
    store(tmp_path, "b", 7, [107])
    go(stream(spark, tmp_path, ["a", "b"]), tmp_path, body)
    assert calls[-1][1] == [107]
    n = len(calls)
    go(stream(spark, tmp_path, ["a", "b"]), tmp_path, body)
    assert sum((rows for _, rows in calls[n:]), []) == []


def test_offsets_admit_a_few_pages():
    there = {"a": 35, "b": 12}
    paged_count = paged.stored_count
    paged.stored_count = lambda key, folder: there[key]
    try:
        r = paged.PolledReader({"keys": '["a", "b"]', "folder": "x", "limit": "3", **FETCH})
        assert r.latestOffset() == there  # after a restart what is taken isn't known before Spark tells it
        r.commit({"a": 0, "b": 0})
        assert r.latestOffset() == {"a": 30, "b": 0}
        assert [(p.key, p.offset, p.size) for p in r.partitions({"a": 0, "b": 0}, {"a": 30, "b": 0})] == [("a", 0, 10), ("a", 10, 10), ("a", 20, 10)]
        assert r.latestOffset() == {"a": 35, "b": 12}
        r.commit({"a": 35, "b": 12})
        there["a"] = 20  # a server that forgets rows doesn't take the stream back
        assert r.latestOffset() == {"a": 35, "b": 12}
    finally:
        paged.stored_count = paged_count


def test_a_page_fails_alone_but_a_missing_fetch_is_an_error(spark, tmp_path):
    store(tmp_path, "a", 0, range(12))
    spark.dataSource.register(paged.PagedSource)
    load = lambda fetch: spark.read.format("paged").options(keys='["a", "down"]', total="12", pagesize="10", folder=str(tmp_path / "pages"), fetch=fetch).load()
    rows = load(FETCH["fetch"]).collect()
    assert sorted((r["key"], r["page"], json.loads(r["row"])["v"]) for r in rows if r["row"]) == [("a", v // 10 * 10, v) for v in range(12)]
    assert sorted((r["key"], r["page"]) for r in rows if r["error"]) == [("down", 0), ("down", 10)]
    with pytest.raises(Exception, match="no_such"):
        load("sparkwharf.sources.paged.no_such").collect()


def test_a_page_opens_only_its_own_files(tmp_path, monkeypatch):
    """With files of a known number of rows no folder of a key is listed."""
    for first in range(0, 100, 4):
        store(tmp_path, "a", first, range(first, min(first + 4, 98)))
    folder = str(tmp_path / "pages")
    whole = [paged.stored_page("a", at, 10, folder) for at in range(0, 120, 10)]
    monkeypatch.setattr(paged, "_lines", None)
    assert [paged.stored_page("a", at, 10, folder, "4") for at in range(0, 120, 10)] == whole
    with pytest.raises(FileNotFoundError):
        paged.stored_page("b", 0, 10, folder, "4")


def test_many_pages_share_a_partition(spark, tmp_path):
    """Partitions stay bounded, and a key without pages still fails a row a page."""
    for first in range(0, 40, 4):
        store(tmp_path, "a", first, range(first, first + 4))
    options = {"keys": '["a", "closed"]', "pagesize": "3", "total": "38", "fetch": FETCH["fetch"], "stored": "4", "folder": str(tmp_path / "pages")}
    assert len(paged.PagedReader({**options, "total": "3000000"}).partitions()) <= paged.PARTITIONS + 2
    spark.dataSource.register(paged.PagedSource)
    got = spark.read.format("paged").options(**options).load().collect()
    assert sorted(json.loads(r["row"])["v"] for r in got if r.error is None) == list(range(39))
    assert sorted(r.page for r in got if r.error) == list(range(0, 39, 3))
