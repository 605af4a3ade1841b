"""Queries that call the endpoints by name from SQL, over daily tables made from the given ones, all days of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwharf.functions import timeutil as tu
from sparkwharf.operators import endpoints, trails
from sparkwharf.plans import history
from sparkwharf.plans.register import query, table
from sparkwharf.sources.shared import folder


def daily(rows: DataFrame, name: str) -> DataFrame:
    """A daily table, partitioned by day so that calls prune."""
    path = folder(rows.sparkSession, name)
    rows.write.partitionBy("day").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _trails(spark, sf, where=None) -> DataFrame:
    """Trails of each civil day widened by an hour, as in the backfill of all days."""
    ev = table(spark, sf, "events")
    days = F.array_distinct(F.array(*[F.to_date(tu.shifted(F.col("ts"), tu.OFFSET_HOURS + h)) for h in (-1, 1)]))
    rows = (ev if where is None else ev.filter(where)).withColumn("day", F.explode(days))
    agg = rows.groupBy("day", F.col("user_id").cast("string").alias("mmsi")).agg(F.max("event_type").alias("ship_type"), trails.packed(history._order(), history._point()).alias("trail"), F.count(F.lit(1)).alias("n"))
    return agg.filter("n >= 2")


_DAYS = "WITH d AS (SELECT CAST(unnest(generate_series((SELECT min(ts)::DATE - 2 FROM events), (SELECT max(ts)::DATE + 2 FROM events), INTERVAL 1 DAY)) AS DATE) AS day)"
_JOIN = "FROM d JOIN events ON ts >= day - INTERVAL 9 HOUR AND ts < day + INTERVAL 17 HOUR"
_ALL = f"{_DAYS}, t AS (SELECT day, user_id::VARCHAR AS mmsi, max(event_type) AS ship_type, string_agg({history._POINT}, ';' ORDER BY ts, event_id) AS trail, count(*) AS n {_JOIN} GROUP BY 1, 2 HAVING count(*) >= 2)"


def _register_ships(spark, sf) -> None:
    made = daily(_trails(spark, sf), "ship_trails")
    summary = made.groupBy("day").agg(F.sum("n").alias("records"), F.count(F.lit(1)).alias("ships"))
    endpoints.register(spark, {"ship_trails_daily": made, "ship_trails_days_summary": summary})


@query("d1_a1_ship_trails", _ALL + " SELECT strftime(day, '%Y-%m-%d') AS day, mmsi, ship_type, trail FROM t")
def ship_trails(spark, sf):
    """Every day's trails, a call for each day that has any."""
    _register_ships(spark, sf)
    return spark.sql("SELECT date_format(d.day, 'yyyy-MM-dd') AS day, f.mmsi, f.ship_type, f.trail FROM (SELECT CAST(date AS DATE) AS day FROM get_ship_dates()) d, LATERAL get_ship_trails(d.day) f")


@query("d1_a1_ship_dates", _ALL + " SELECT strftime(day, '%Y-%m-%d') AS date, sum(n)::BIGINT AS records, count(*) AS ships FROM t GROUP BY day")
def ship_dates(spark, sf):
    _register_ships(spark, sf)
    return spark.sql("SELECT * FROM get_ship_dates()")


@query("d1_a2_flight_trails", f"""
{_DAYS} SELECT strftime(day, '%Y-%m-%d') AS day, user_id::VARCHAR AS flight_id, max(event_type) AS callsign, string_agg({history._POINT}, ';' ORDER BY ts, event_id) AS trail {_JOIN} WHERE value >= 20 GROUP BY day, user_id HAVING count(*) >= 2""")
def flight_trails(spark, sf):
    rows = _trails(spark, sf, F.col("value") >= 20).select("day", F.col("mmsi").alias("flight_id"), F.col("ship_type").alias("callsign"), *[F.lit("").alias(c) for c in ("aircraft_type", "origin", "destination")], "trail")
    made = daily(rows, "flight_trails")
    days = made.groupBy("day").agg(F.count(F.lit(1)).alias("flights"), F.count(F.lit(1)).alias("records"))
    endpoints.register(spark, {"flight_trails_daily": made, "flight_trails_days_summary": days})
    return spark.sql("SELECT date_format(d.day, 'yyyy-MM-dd') AS day, f.flight_id, f.callsign, f.trail FROM (SELECT CAST(date AS DATE) AS day FROM get_flight_dates()) d, LATERAL get_flight_trails(d.day) f")


@query("d1_a3_congestion_days", """
SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, l_suppkey::VARCHAR AS section_id, trim(max(s_name)) AS section_name, string_agg(l_orderkey || ',' || CAST(l_quantity AS BIGINT), ';' ORDER BY l_orderkey, l_linenumber, l_quantity) AS timeline
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_shipdate, l_suppkey""")
def congestion_days(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.trim("s_name").alias("section_name"))
    point = F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("l_quantity").cast("long").cast("string"))
    per = table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("day"), "l_suppkey").agg(trails.packed([F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity")], point).alias("timeline"))
    rows = per.join(s, "l_suppkey").select("day", F.col("l_suppkey").cast("string").alias("section_id"), "section_name", *[F.lit("").alias(c) for c in ("road_name", "direction_label", "geom")], "timeline")
    endpoints.register(spark, {"freeway_congestion_daily": rows})
    return spark.sql("SELECT date_format(d.day, 'yyyy-MM-dd') AS day, f.section_id, f.section_name, f.timeline FROM (SELECT DISTINCT day FROM freeway_congestion_daily) d, LATERAL get_freeway_congestion_day(d.day) f")


@query("d1_a4_bike_snapshots", history._QUARTERS + """
SELECT left(time_key, 10) AS day, resolution, time_key, '[' || string_agg('{"h":"' || cell || '","fr":' || CAST(round(CAST(fullness AS DECIMAL(20,10)), 4) AS DECIMAL(20,4)) || ',"sc":' || CAST(round(CAST(avg_total AS DECIMAL(20,10)), 1) AS DECIMAL(20,1)) || '}', ',' ORDER BY cell) || ']' AS cells
FROM q WHERE fullness IS NOT NULL GROUP BY resolution, time_key""")
def bike_snapshots(spark, sf):
    """Each day at the default resolution, and at the other one by name."""
    rows = trails.cell_frames(history._quarters(spark, sf)).withColumn("day", F.to_date(F.left("time_key", F.lit(10))))
    endpoints.register(spark, {"bike_cells_daily": daily(rows, "bike_cells")})
    call = "SELECT date_format(d.day, 'yyyy-MM-dd') AS day, {r} AS resolution, f.time_key, f.cells FROM (SELECT DISTINCT day FROM bike_cells_daily) d, LATERAL get_youbike_h3_snapshots(d.day{a}) f"
    return spark.sql(f"{call.format(r=7, a='')} UNION ALL {call.format(r=8, a=', h3_resolution => 8')}")


@query("d1_a6_temperature_frames", """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS observed, count(*)::INT AS cell_count, string_agg(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY o_custkey, o_orderkey) AS temps FROM orders GROUP BY o_orderdate""")
def temperature_frames(spark, sf):
    temps = trails.packed([F.col("o_custkey"), F.col("o_orderkey")], F.round(F.col("o_totalprice") * 100).cast("long").cast("string"), ",")
    rows = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("timestamp_ntz").alias("observed_at")).agg(F.count(F.lit(1)).cast("int").alias("cell_count"), temps.alias("temps"))
    endpoints.register(spark, {"temperature_frames_daily": rows.withColumn("day", F.to_date("observed_at"))})
    return spark.sql("SELECT date_format(f.observed_at, 'yyyy-MM-dd') AS observed, f.cell_count, f.temps FROM (SELECT DISTINCT day FROM temperature_frames_daily) d, LATERAL get_temperature_frames(d.day) f")


@query("d4_trip_legs", """
WITH e AS (SELECT user_id AS entity, (epoch_us(ts) + 500000) // 1000000 AS t FROM events), g AS (SELECT *, CASE WHEN t - lag(t) OVER w > 3600 THEN 1 ELSE 0 END AS cut FROM e WINDOW w AS (PARTITION BY entity ORDER BY t)),
l AS (SELECT *, sum(cut) OVER (PARTITION BY entity ORDER BY t) AS leg FROM g)
SELECT entity, leg::INT AS leg, min(t) AS first, max(t) AS last, count(*)::INT AS points FROM l GROUP BY 1, 2""")
def trip_legs(spark, sf):
    """A table function in Python over partitioned, sorted input, called from SQL; a gap of an hour."""
    endpoints.register(spark, {})
    table(spark, sf, "events").select(F.col("user_id").alias("entity"), tu.epoch_seconds(F.col("ts")).alias("at")).createOrReplaceTempView("trip_points")
    return spark.sql("SELECT * FROM trip_legs(TABLE(trip_points), 3600)")
