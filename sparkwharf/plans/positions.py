"""Queries: windows, sessions and trips over event positions.

Positions are derived from event values: latitude 24 and longitude 121 plus hundredths.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkwharf.functions import geo
from sparkwharf.functions import timeutil as tu
from sparkwharf.operators import trips
from sparkwharf.plans.register import query, table

_POS = "(SELECT *, 24 + (event_id % 97) / 1000.0::DOUBLE AS lat, 121 + (event_id % 89) / 1000.0::DOUBLE AS lng FROM events)"
_KM = "(2 * 6371.0 * asin(sqrt(pow(sin(radians(lat - plat) / 2), 2) + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lng - plng) / 2), 2))))"


def positions(spark, sf):
    return table(spark, sf, "events").withColumns({"lat": F.lit(24.0) + (F.col("event_id") % 97) / F.lit(1000.0), "lng": F.lit(121.0) + (F.col("event_id") % 89) / F.lit(1000.0)})


@query("w1_w3_g10_trips", """
WITH d AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) = 1),
g AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) > 900000000 THEN 1 ELSE 0 END AS s FROM d),
t AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS trip_id FROM g)
SELECT user_id, trip_id::INT AS trip_id, epoch_us(min(ts)) AS started, epoch_us(max(ts)) AS ended, count(*)::INT AS point_count, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ts) AS points
FROM t GROUP BY user_id, trip_id HAVING count(*) >= 2""")
def trip_groups(spark, sf):
    once = trips.first_per_key(table(spark, sf, "events"), ["user_id", "ts"], [F.col("event_id")])
    made = trips.group_trips(trips.with_trip_id(once, ["user_id"], "ts"), ["user_id"], "ts", F.col("event_id").cast("string"))
    return made.select("user_id", "trip_id", tu.epoch_micros(F.col("started_at")).alias("started"), tu.epoch_micros(F.col("ended_at")).alias("ended"), "point_count", F.array_join("points", ",").alias("points"))


@query("w4_f30_speed_filter", f"""
WITH p AS {_POS}, l AS (SELECT *, lag(ts) OVER w AS pt, lag(lat) OVER w AS plat, lag(lng) OVER w AS plng FROM p WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
v AS (SELECT *, CASE WHEN pt IS NULL THEN 0 ELSE {_KM} / nullif((epoch_us(ts) - epoch_us(pt)) / 3.6e9, 0) END AS speed FROM l)
SELECT event_id FROM v WHERE speed IS NULL OR speed <= 20""")
def speed_filter(spark, sf):
    # a unique time, so that the order is total
    p = positions(spark, sf).withColumn("at", F.col("ts"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    lag = lambda c: F.lag(c).over(w)
    km = geo.haversine_km(lag("lat"), lag("lng"), F.col("lat"), F.col("lng"))
    hours = (tu.epoch_micros(F.col("ts")) - tu.epoch_micros(lag("ts"))) / F.lit(3.6e9)
    v = p.withColumn("speed", F.when(lag("ts").isNull(), F.lit(0.0)).otherwise(km / F.nullif(hours, F.lit(0.0))))
    return v.filter(F.col("speed").isNull() | (F.col("speed") <= 20)).select("event_id")


@query("g22_w2_f31_contradictions", f"""
WITH p AS {_POS}, l AS (SELECT *, lag(ts) OVER w AS pt, lag(lat) OVER w AS plat, lag(lng) OVER w AS plng FROM p WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
v AS (SELECT user_id, {_KM} / 1.852 / nullif((epoch_us(ts) - epoch_us(pt)) / 3.6e9, 0) AS kn FROM l)
SELECT user_id, count(*) AS fast FROM v WHERE kn > 1.0 GROUP BY user_id HAVING count(*) >= 3""")
def contradictions(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    lag = lambda c: F.lag(c).over(w)
    km = geo.haversine_km(lag("lat"), lag("lng"), F.col("lat"), F.col("lng"))
    kn = geo.knots(km, (tu.epoch_micros(F.col("ts")) - tu.epoch_micros(lag("ts"))) / F.lit(1e6))
    return positions(spark, sf).withColumn("kn", kn).filter("kn > 1.0").groupBy("user_id").agg(F.count(F.lit(1)).alias("fast")).filter("fast >= 3")


@query("t5_session_window", """
WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) > 900000000 THEN 1 ELSE 0 END AS s FROM events),
t AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
SELECT user_id, epoch_us(min(ts)) AS started, count(*) AS n FROM t GROUP BY user_id, k""")
def session_window(spark, sf):
    # a session's end is exclusive, so a gap of exactly the limit needs one microsecond more to stay inside
    s = table(spark, sf, "events").groupBy("user_id", F.session_window("ts", "900 seconds 1 microsecond").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("t"))
    return s.select("user_id", tu.epoch_micros(F.col("t")).alias("started"), "n")


@query("t4_tumbling", "SELECT strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M') AS w, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY ALL")
def tumbling(spark, sf):
    ev = table(spark, sf, "events")
    agg = ev.groupBy(F.window("ts", "15 minutes").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))
    return agg.select(F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("w"), "event_type", "n", "cents")


@query("w5_g15_o2_latest_per_key", """
SELECT o_custkey, o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1""")
def latest_per_key(spark, sf):
    newest = trips.first_per_key(table(spark, sf, "orders"), ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()])
    return newest.select("o_custkey", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))


@query("w6_islands", """
WITH f AS (SELECT *, value BETWEEN 20 AND 60 AS i FROM events), g AS (SELECT *, CASE WHEN i AND NOT coalesce(lag(i) OVER (PARTITION BY user_id ORDER BY event_id), FALSE) THEN 1 ELSE 0 END AS s FROM f),
r AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT user_id, run::INT AS run, min(event_id) AS first, max(event_id) AS last, count(*) AS n FROM r WHERE i GROUP BY user_id, run""")
def islands(spark, sf):
    return trips.islands(table(spark, sf, "events"), ["user_id"], "event_id", F.col("value").between(20, 60))


@query("w7_w8_progress", """
SELECT l_orderkey, l_linenumber, CAST(sum(CAST(l_quantity AS BIGINT)) OVER w AS BIGINT) AS length, CAST(max(CAST(l_quantity AS BIGINT)) OVER w AS BIGINT) AS clamped FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity ROWS UNBOUNDED PRECEDING)""")
def progress(spark, sf):
    q = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("q"))
    order = ["l_linenumber", "l_partkey", "l_suppkey", "q"]
    both = trips.running_maximum(trips.cumulative_length(q, ["l_orderkey"], order, F.col("q"), "length"), ["l_orderkey"], order, "q", "clamped")
    return both.select("l_orderkey", "l_linenumber", "length", "clamped")


@query("w9_adjacent_pairs", """
SELECT l_orderkey, p AS from_part, l_partkey AS to_part FROM (SELECT *, lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS p FROM lineitem) WHERE p IS NOT NULL""")
def adjacent_pairs(spark, sf):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    li = table(spark, sf, "lineitem").withColumn("from_part", F.lag("l_partkey").over(w)).filter(F.col("from_part").isNotNull())
    return li.select("l_orderkey", "from_part", F.col("l_partkey").alias("to_part"))


@query("w11_g29_revisions", """
SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_partkey, l_suppkey) AS copies, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber, l_shipdate, l_quantity)::INT AS revision FROM lineitem""")
def revisions(spark, sf):
    return trips.revisions(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber", "l_shipdate", "l_quantity"]).select("l_orderkey", "l_linenumber", "copies", "revision")


@query("w12_downsample", """
SELECT user_id, event_id, epoch_us(ts) // 900000000 AS bucket FROM events QUALIFY row_number() OVER (PARTITION BY user_id, epoch_us(ts) // 900000000 ORDER BY ts DESC) = 1""")
def downsample(spark, sf):
    return trips.last_per_bucket(table(spark, sf, "events"), ["user_id"], "ts", 900).select("user_id", "event_id", "bucket")


@query("w13_chunks", """
WITH a AS (SELECT user_id, list(event_id ORDER BY ts, event_id) AS ids FROM events GROUP BY user_id),
c AS (SELECT *, unnest(range(0, greatest(ceil((len(ids) - 1) / 9.0), 1)::BIGINT)) AS chunk FROM a)
SELECT user_id, chunk::INT AS chunk, array_to_string(ids[chunk * 9 + 1 : chunk * 9 + 10], ',') AS ids FROM c""")
def chunked(spark, sf):
    a = table(spark, sf, "events").groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id"))), lambda x: x["event_id"]).alias("ids"))
    return trips.chunks(a, "ids", 10).select("user_id", "chunk", F.array_join("ids", ",").alias("ids"))


@query("j7_x6_nearest_place", """
WITH p AS (SELECT event_id, 121 + (event_id % 89) / 1000.0::DOUBLE AS lng, 24 + (event_id % 97) / 1000.0::DOUBLE AS lat FROM events),
s AS (SELECT s_suppkey, 121 + (s_suppkey * 7 % 89) / 1000.0::DOUBLE + 0.0003 AS slng, 24 + (s_suppkey * 11 % 97) / 1000.0::DOUBLE + 0.0002 AS slat FROM supplier)
SELECT event_id, s_suppkey AS place_id FROM p LEFT JOIN s ON abs(lng - slng) <= 0.0015 AND abs(lat - slat) <= 0.0015
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY pow(lng - slng, 2) + pow(lat - slat, 2), s_suppkey) = 1""")
def nearest_place(spark, sf):
    places = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("place_id"),
        (F.lit(121.0) + (F.col("s_suppkey") * 7 % 89) / F.lit(1000.0) + 0.0003).alias("lng"),
        (F.lit(24.0) + (F.col("s_suppkey") * 11 % 97) / F.lit(1000.0) + 0.0002).alias("lat"),
    )
    return trips.nearest(positions(spark, sf).select("event_id", "lng", "lat"), places, ["event_id"], 0.0015).select("event_id", "place_id")


@query("j9_u4_trip_pipeline", f"""
WITH r AS (SELECT * FROM {_POS} WHERE ts >= TIMESTAMP '2024-01-04 16:00:00' AND ts < TIMESTAMP '2024-01-15 16:00:00' QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) = 1),
l AS (SELECT *, lag(ts) OVER w AS pt, lag(lat) OVER w AS plat, lag(lng) OVER w AS plng FROM r WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
c AS (SELECT * FROM (SELECT *, CASE WHEN pt IS NULL THEN 0 ELSE {_KM} / nullif((epoch_us(ts) - epoch_us(pt)) / 3.6e9, 0) END AS v FROM l) WHERE v IS NULL OR v <= 60),
g AS (SELECT user_id, event_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) > 900000000 THEN 1 ELSE 0 END AS s FROM c),
t AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts)::INT AS trip_id FROM g),
x AS (SELECT user_id, trip_id, epoch_us(min(ts)) AS started, count(*)::INT AS point_count FROM t GROUP BY ALL HAVING count(*) >= 2)
SELECT * FROM x WHERE trip_id % 3 <> 0 AND trip_id % 5 <> 0""")
def trip_pipeline(spark, sf):
    """Day range, de-duplication, speed filter, gap split, grouping, and two ledgers that take trips out."""
    low, high = tu.day_bounds("2024-01-05")[0], tu.day_bounds("2024-01-15")[1]
    rows = positions(spark, sf).filter((F.col("ts") >= F.lit(str(low)).cast("timestamp_ntz")) & (F.col("ts") < F.lit(str(high)).cast("timestamp_ntz")))
    once = trips.first_per_key(rows, ["user_id", "ts"], [F.col("event_id")])
    kept = trips.with_trip_id(trips.drop_spikes(once, ["user_id"], "ts"), ["user_id"], "ts")
    made = trips.group_trips(kept, ["user_id"], "ts", F.col("event_id"))
    done, tried = made.filter("trip_id % 3 = 0"), made.filter("trip_id % 5 = 0")
    return trips.pending(made, ["user_id", "trip_id"], done, tried).select("user_id", "trip_id", tu.epoch_micros(F.col("started_at")).alias("started"), "point_count")


@query("t14_recovery", """
SELECT user_id, event_id, gap // 3600000000 AS gap_hours FROM (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events) WHERE gap > 3 * 86400000000""")
def recovery(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = tu.epoch_micros(F.col("ts")) - tu.epoch_micros(F.lag("ts").over(w))
    return table(spark, sf, "events").withColumn("gap", gap).filter(F.col("gap") > 3 * 86_400_000_000).select("user_id", "event_id", F.floor(F.col("gap") / F.lit(3_600_000_000)).alias("gap_hours"))
