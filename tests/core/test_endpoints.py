import datetime

import pytest

from sparkwharf.operators import endpoints as m


def test_defaults_names_and_days(spark):
    today = datetime.date.today()
    frames = spark.createDataFrame([(today, datetime.datetime(2024, 1, 1, 3), 2, "1,2"), (today - datetime.timedelta(1), None, 1, "9")], "day date, observed_at timestamp_ntz, cell_count int, temps string")
    cells = spark.createDataFrame([(today, 7, "a", "[7]"), (today, 8, "a", "[8]")], "day date, resolution int, time_key string, cells string")
    grid = spark.createDataFrame([(25.0, 121.0), (24.0, 121.0)], "grid_lat double, grid_lng double")
    made = m.register(spark, {"temperature_frames_daily": frames, "bike_cells_daily": cells, "temperature_grid_cells": grid})
    assert made == ["get_temperature_frames", "get_youbike_h3_snapshots", "get_temperature_grid_info"]
    rows = lambda q: [tuple(r) for r in spark.sql(q).collect()]
    assert rows("SELECT cell_count, temps FROM get_temperature_frames()") == [(2, "1,2")]
    assert rows("SELECT temps FROM get_temperature_frames(date_sub(current_date(), 1))") == [("9",)]
    assert rows(f"SELECT * FROM get_youbike_h3_snapshots(DATE'{today}')") == [("a", "[7]")]
    assert rows(f"SELECT * FROM get_youbike_h3_snapshots(h3_resolution => 8, target_date => DATE'{today}')") == [("a", "[8]")]
    assert rows("SELECT * FROM get_temperature_grid_info()") == [(24.0, 121.0), (25.0, 121.0)]
    with pytest.raises(ValueError, match="no endpoint"):
        m.register(spark, {"other": grid})


def test_a_call_reads_its_day_only(spark, tmp_path):
    rows = spark.createDataFrame([(datetime.date(2024, 1, d), f"s{d}", "cargo", "t") for d in (1, 2, 3)], "day date, mmsi string, ship_type string, trail string")
    rows.write.partitionBy("day").parquet(str(tmp_path / "t"))
    m.register(spark, {"ship_trails_daily": spark.read.schema(rows.schema).parquet(str(tmp_path / "t"))})
    call = spark.sql("SELECT * FROM get_ship_trails(DATE'2024-01-02')")
    assert [r["mmsi"] for r in call.collect()] == ["s2"]
    assert "PartitionFilters: [isnotnull(day" in call._jdf.queryExecution().toString()


def test_trip_legs(spark):
    m.register(spark, {})
    points = [("a", t) for t in (100, 0, 2000, 901, 5000)] + [("b", 7), ("b", None), (None, 3), (None, 2000)]
    spark.createDataFrame(points, "entity string, at long").repartition(4).createOrReplaceTempView("points")
    got = {tuple(r) for r in spark.sql("SELECT * FROM trip_legs(TABLE(points))").collect()}
    assert got == {("a", 0, 0, 901, 3), ("a", 1, 2000, 2000, 1), ("a", 2, 5000, 5000, 1), ("b", 0, 7, 7, 1), (None, 0, 3, 3, 1), (None, 1, 2000, 2000, 1)}
    wide = {tuple(r) for r in spark.sql("SELECT * FROM trip_legs(TABLE(SELECT * FROM points WHERE entity = 'a'), 100000)").collect()}
    assert wide == {("a", 0, 0, 5000, 5)}
    with pytest.raises(Exception, match="takes TABLE"):
        spark.sql("SELECT * FROM trip_legs(TABLE(SELECT entity FROM points))").collect()
