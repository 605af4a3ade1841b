"""Stored tables through a crash, appends, exports, and near-duplicate titles against a plain pass."""

import gzip
import json
from glob import glob

import pytest
from pyspark.sql import functions as F

from sparkwharf.operators import dedup
from sparkwharf.plans import registry
from sparkwharf.plans.formats import FEEDS
from sparkwharf.sources import sinks, specs

from .test_queries import SF

SPEC = specs.TableSpec("t", specs.schema_of("k string, v int"), ("k",), "upsert")


def rows(spark, *pairs):
    return spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(pairs)], "k string, v int, _seq long")


def held(store, spec=SPEC):
    return sorted(map(tuple, store.read(spec).collect()))


def test_a_version_that_was_not_finished_is_not_read(spark, tmp_path):
    store = sinks.Store(spark, str(tmp_path / "store"))
    store.write(SPEC, rows(spark, ("a", 1), ("b", 2)))
    newest = store.versions("t")[-1]
    half = tmp_path / "store" / "t" / f"{int(newest.split('-')[0]) + 1:012d}-dead"
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"half a file")  # a crash before the mark of success
    assert held(store) == [("a", 1), ("b", 2)]
    store.write(SPEC, rows(spark, ("b", 3), ("c", 4)))
    assert held(store) == [("a", 1), ("b", 3), ("c", 4)]
    assert newest in store.versions("t")  # the version before stays for its readers


def test_of_two_writers_the_first_wins(spark, tmp_path, monkeypatch):
    one, other = (sinks.Store(spark, str(tmp_path / "store")) for _ in range(2))
    one.write(SPEC, rows(spark, ("a", 1)))
    begun = other.versions("t")
    one.write(SPEC, rows(spark, ("b", 2)))
    with monkeypatch.context() as m, pytest.raises(sinks.Conflict):
        m.setattr(other, "versions", lambda name: begun)  # it read the table before the first one was done
        other.write(SPEC, rows(spark, ("c", 3)))
    assert held(one) == [("a", 1), ("b", 2)]
    other.write(SPEC, rows(spark, ("c", 3)))
    assert held(one) == held(other) == [("a", 1), ("b", 2), ("c", 3)]


def test_appends_add_files_only(spark, tmp_path):
    store, spec = sinks.Store(spark, str(tmp_path / "store")), specs.TableSpec("h", specs.schema_of("k string, v int"))
    for n in range(3):
        store.write(spec, rows(spark, ("a", n)))
    assert held(store, spec) == [("a", 0), ("a", 1), ("a", 2)] and len(store.versions("h")) == 1


def test_json_export_is_an_array_in_each_file(spark, tmp_path):
    sinks.export_json_array(spark.range(5).repartition(2), str(tmp_path / "j"))
    read = [json.loads(gzip.open(f, "rt").read()) for f in glob(str(tmp_path / "j" / "*.gz"))]
    assert sorted(r["id"] for file in read for r in file) == list(range(5)) and all(isinstance(f, list) for f in read)


def test_feeds_are_declared_with_their_normalisers():
    assert {s.source for s in FEEDS.tables.values()} <= specs.NORMALISERS.keys()
    assert [s.name for s in FEEDS.of_source("ships")] == ["port_current", "port_history"]


def greedy(items, horizon):
    """``items`` of (seq, at, sig) in order."""
    kept = []
    for seq, at, sig in items:
        if not any(at - t <= horizon and (sig ^ s).bit_count() <= 3 for _, t, s in kept):
            kept.append((seq, at, sig))
    return [seq for seq, _, _ in kept]


def test_near_titles_against_a_plain_pass(spark):
    titles = [(r.p_partkey, r.title) for r in spark.read.parquet(f"{SF}/part.parquet").select("p_partkey", F.lower(F.regexp_replace("p_name", r"[^\p{L}\p{N}]", "")).alias("title")).orderBy("p_partkey").collect()]
    want = greedy([(k, k * 3600, dedup.signature(t)) for k, t in titles], 7 * 86400)
    assert sorted(r.p_partkey for r in registry.QUERIES["t7_near_titles"](spark, SF).collect()) == want


def test_greedy_within_a_horizon(spark):
    items = [(i, i * 10, (0x0F0F << 40) ^ (1 << (i * 7 % 5))) for i in range(40)] + [(100 + i, 400 + i, (i * 0x9E3779B97F4A7C15) % (1 << 63)) for i in range(40)]
    got = dedup.greedy_keep(spark.createDataFrame(items, "seq long, at long, sig long"), horizon=35).collect()
    assert sorted(r.seq for r in got) == greedy(items, 35)
