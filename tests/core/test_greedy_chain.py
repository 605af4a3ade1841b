import random
import re

import pytest

from sparkwharf.operators import dedup


def test_unsettled_chain_is_an_error(spark):
    """Row i differs from row i - 1 in 2 bits and from earlier ones in more than 3: every other row stays."""
    rows = spark.createDataFrame([(i, (1 << 2 * i) - 1) for i in range(9)], "seq long, sig long")
    assert sorted(r.seq for r in dedup.greedy_keep(rows).collect()) == [0, 2, 4, 6, 8]
    with pytest.raises(RuntimeError):
        dedup.greedy_keep(rows, max_rounds=2)


def test_what_recurs_doesnt_meet_all_its_past(spark):
    """One title a week for 40 weeks within a horizon of 7 days less a second: all stay, and hardly any two are compared."""
    week = 7 * 86400
    rows = [(i, i * week, 5) for i in range(40)] + [(100, 39 * week + 60, 4)]
    df = spark.createDataFrame(rows, "seq long, at long, sig long")
    pairs = dedup.near_pairs(df, horizon=week - 1)
    assert [tuple(r) for r in pairs.collect()] == [(100, 39)]
    assert {r.seq for r in dedup.greedy_keep(df, horizon=week - 1).collect()} == set(range(40))
    assert {tuple(r) for r in dedup.near_pairs(df, horizon=week).collect()} == {(i + 1, i) for i in range(39)} | {(100, 39)}


@pytest.mark.parametrize("crowd", [2, 256])
def test_pairs_of_crowds_against_brute_force(spark, monkeypatch, crowd):
    """Rows are multiplied by bands, so no side may be broadcast by its table's size; crowds are told apart by a second band."""
    monkeypatch.setattr(dedup, "CROWD", crowd)
    rng = random.Random(crowd)
    base = [rng.getrandbits(63) for _ in range(3)]
    rows = [(i, i * 10, rng.choice(base) ^ sum(1 << rng.randrange(63) for _ in range(rng.randint(0, 3)))) for i in range(90)]
    df = spark.createDataFrame(rows, "seq long, at long, sig long")
    for horizon in (None, 200):
        pairs = dedup.near_pairs(df, horizon=horizon)
        near = {(i, j) for i, s, x in rows for j, t, y in rows if j < i and (x ^ y).bit_count() <= 3 and (horizon is None or s - t <= horizon)}
        assert {tuple(r) for r in pairs.collect()} == near
        shape = pairs._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"BroadcastHashJoin [^\n]*Inner", shape) and shape.count("SortMergeJoin") >= 2
