import random
import re

from pyspark.sql import functions as F

from sparkwharf.operators import lookups, trips
from sparkwharf.plans import registry

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_products_of_the_grid_stay_in_32_bits(spark, tmp_path):
    """0.3195 as a float times 1000 is 319.5 in 32 bits and 319.49999 in 64."""
    spark.createDataFrame([(1, [0.3195] * 64)], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert {r.milli for r in registry.QUERIES["p3_s20_grid_unnest"](spark, str(tmp_path)).collect()} == {320}


def test_rows_of_stations_are_not_broadcast(spark):
    """A track's stations multiply its rows beyond what the table's size tells."""
    assert "BroadcastHashJoin" not in plan(registry.QUERIES["j20_o8_tracks"](spark, SF))


def test_sections_against_a_plain_pass(spark):
    rng = random.Random(5)
    sections = [(f"r{rng.randint(0, 3)}", rng.choice(["N", "S", None]), a, a + rng.choice([-1, 0, 1, 2.5, 17]), k) for k in range(150) for a in [rng.randint(0, 60) / 2]]
    points = [(i, rng.choice(["r0", "r1", "r2", "r3", "none", None]), rng.choice(["N", "S", "B", "X", None]), rng.choice([None, rng.randint(-4, 80) / 2])) for i in range(300)]
    want = []
    for i, road, way, km in points:
        own = [s for s in sections if s[0] == road]
        if way != "B" and any(s[1] == way and way for s in own):
            met = [s for s in own if s[1] == way]
        else:
            met = own
        hit = sorted((s[2], s[4]) for s in met if km is not None and s[2] <= km <= s[3])
        want.append((i, "no_section" if not own else "km_out" if not hit else "matched" if len(hit) == 1 else "multi_match", hit[0][1] if hit else None))
    got = lookups.match_sections(spark.createDataFrame(points, "id int, road string, dir string, km double"), spark.createDataFrame(sections, "road string, dir string, low double, high double, section int"), 5.0)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_crowded_sections_form_no_pairs(spark):
    """2,000 points in 2,000 sections each: no step has more rows than the tables."""
    p = spark.range(2000).select(F.col("id"), F.lit("r").alias("road"), F.lit("N").alias("dir"), (1 + F.col("id") % 3).cast("double").alias("km"))
    s = spark.range(2000).select(F.lit("r").alias("road"), F.lit("N").alias("dir"), F.lit(0.0).alias("low"), F.lit(4.0).alias("high"), F.col("id").alias("section"))
    out = lookups.match_sections(p, s, 5.0)
    assert [tuple(r) for r in out.select("status", "section").distinct().collect()] == [("multi_match", 0)]
    assert "_cell" not in "".join(re.findall(r"Join [^\n]*", plan(out)))


def test_events_of_a_place_share_its_zones(spark):
    shape = plan(registry.QUERIES["j14_x8_p9_boxes"](spark, SF))
    assert "event_id" not in re.search(r"Join \[[^\n]*_x[^\n]*", shape)[0]


def test_places_are_looked_up_once_a_position(spark):
    """All points and places at two positions: pairs are formed of positions, not of rows."""
    points = spark.range(3000).select(F.col("id").alias("event"), (F.col("id") % 2 * 5).cast("double").alias("lng"), F.lit(1.0).alias("lat"))
    places = spark.range(500).select((F.col("id") + 7).alias("place_id"), (F.col("id") * 0 + 0.0005).alias("lng"), (F.col("id") * 0 + 1.0).alias("lat"))
    near = trips.nearest(points, places, ["event"], 0.001)
    assert [tuple(r) for r in near.groupBy("lng", "place_id").count().orderBy("lng").collect()] == [(0.0, 7, 1500), (5.0, None, 1500)]
    assert all(re.search(rf"HashAggregate\(keys=\[[^\]]*{name}", plan(near)) for name in ("place_lng", "lng#"))
    assert "BroadcastHashJoin [_cx" not in plan(near)


def test_a_gate_deals_its_rows_once(spark):
    """One exchange by run, and no distinct count that multiplies rows before it."""
    shape = plan(registry.QUERIES["m8_gate"](spark, SF))
    assert shape.count("Exchange hashpartitioning") == 1 and "Expand" not in shape
