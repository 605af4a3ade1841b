"""Queries over free polygons: unions, simplified outlines, tracks that meet areas, and the alert day.

Areas are stars of five to eight corners around places that the tables' keys give; their corners lie off round numbers, so no
point that is asked for lies on an edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwharf.functions import geo
from sparkwharf.functions import timeutil as tu
from sparkwharf.operators import planar, polygon_joins, simplify
from sparkwharf.plans.register import query, table

#: Directions of a star's corners, against the clock.
FIVE = ((0.0, -1.0), (0.95, -0.31), (0.59, 0.81), (-0.59, 0.81), (-0.95, -0.31))
EIGHT = ((1.0, 0.0), (0.7, 0.7), (0.0, 1.0), (-0.7, 0.7), (-1.0, 0.0), (-0.7, -0.7), (0.0, -1.0), (0.7, -0.7))


def star(key: Column, x: Column, y: Column, size: float, corners) -> Column:
    """One ring; a corner's distance is half to all of ``size``, by the key."""
    at = lambda i, dx, dy: F.struct((x + dx * (F.lit(size) * (7 + key * (i + 3) % 7) / 13)).alias("lng"), (y + dy * (F.lit(size) * (7 + key * (i + 3) % 7) / 13)).alias("lat"))
    return F.array(*[at(i, dx, dy) for i, (dx, dy) in enumerate(corners)])


def star_sql(key: str, x: str, y: str, size: float, corners) -> str:
    """Rows ``i, lng, lat`` of the corners as a list of structs."""
    return "[" + ", ".join(f"{{'lng': {x} + {dx} * ({size} * (7 + {key} * {i + 3} % 7) / 13), 'lat': {y} + {dy} * ({size} * (7 + {key} * {i + 3} % 7) / 13)}}" for i, (dx, dy) in enumerate(corners)) + "]"


#: SQL of whether (px, py) is in the ring.
IN_RING = """len(list_filter(range(1, len(ring) + 1), lambda i: (ring[i].lat > py) <> (ring[i % len(ring) + 1].lat > py)
 AND px < (ring[i % len(ring) + 1].lng - ring[i].lng) * (py - ring[i].lat) / (ring[i % len(ring) + 1].lat - ring[i].lat) + ring[i].lng)) % 2 = 1"""


def grid(spark, n: int, step: float) -> DataFrame:
    """``point, way``: n x n places."""
    p = F.col("id")
    at = F.struct(((p % n) * step + 0.01371).alias("lng"), (F.floor(p / n) * step + 0.02219).alias("lat"))
    return spark.range(n * n).select(p.alias("point"), F.array(at).alias("way"))


def grid_sql(n: int, step: float) -> str:
    return f"SELECT p AS point, (p % {n}) * {step} + 0.01371 AS px, (p // {n}) * {step} + 0.02219 AS py FROM range({n * n}) r(p)"


@query("x7_d5_union_points", f"""
WITH c AS (SELECT c_nationkey AS nation, {star_sql('c_custkey', '(c_custkey * 37 % 1009) / 100.0', '(c_custkey * 53 % 997) / 100.0', 0.9, FIVE)} AS ring FROM customer), p AS ({grid_sql(25, 0.4)})
SELECT DISTINCT point, nation FROM c, p WHERE {IN_RING}""")
def union_points(spark, sf):
    """The customers' areas of each nation become one; places are looked up in what came of it."""
    k = F.col("c_custkey")
    areas = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.array(star(k, (k * 37 % 1009) / 100.0, (k * 53 % 997) / 100.0, 0.9, FIVE)).alias("rings"))
    whole = planar.union(areas, "nation", "rings").select("nation", F.explode("polygons").alias("rings"))
    return polygon_joins.meet(grid(spark, 25, 0.4), "point", "way", whole, "nation", "rings")


@query("g9_x7_union_areas", """
SELECT custkey, count(*)::DOUBLE AS area FROM (SELECT DISTINCT o_custkey AS custkey, o_orderkey * 7 % 50 + i AS x, o_orderkey * 11 % 50 + j AS y FROM orders, range(9) a(i), range(6) b(j) WHERE i <= o_orderkey % 9 AND j <= o_orderkey % 6) GROUP BY 1""")
def union_areas(spark, sf):
    """Areas of unions of boxes; in SQL the cells that they cover are counted."""
    k = F.col("o_orderkey")
    x, y = k * 7 % 50, k * 11 % 50
    east, north = x + 1 + k % 9, y + 1 + k % 6
    at = lambda a, b: F.struct(a.cast("double").alias("lng"), b.cast("double").alias("lat"))
    boxes = table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"), F.array(F.array(at(x, y), at(east, y), at(east, north), at(x, north))).alias("rings"))
    edges = planar.union_layer(boxes, "custkey", "rings")
    return edges.groupBy(F.col("k").alias("custkey")).agg((F.sum(F.expr("CAST(px AS DOUBLE) * qy - CAST(qx AS DOUBLE) * py")) / 2 * planar.UNIT**2).alias("area")).withColumn("area", F.round("area", 6))


@query("j14_x8_pass_areas", f"""
WITH n AS (SELECT n_name AS name, {star_sql('n_nationkey', '(n_nationkey % 5) * 2.0 + 1', '(n_nationkey // 5) * 2.0 + 1', 1.3, EIGHT)} AS ring FROM nation),
l AS (SELECT l_orderkey AS pass, l_linenumber, (l_partkey * 7 % 1009) / 100.0 + 0.00373 AS px, (l_suppkey * 31 % 997) / 100.0 + 0.00119 AS py FROM lineitem),
t AS (SELECT *, row_number() OVER (PARTITION BY pass ORDER BY l_linenumber, px, py) AS i FROM l),
s AS (SELECT *, lead(px) OVER w AS qx, lead(py) OVER w AS qy FROM t WINDOW w AS (PARTITION BY pass ORDER BY i)),
e AS (SELECT name, ring[i].lng AS ax, ring[i].lat AS ay, ring[i % 8 + 1].lng AS ex, ring[i % 8 + 1].lat AS ey FROM n, range(1, 9) r(i)),
h AS (
  SELECT pass, name FROM s JOIN e ON qx IS NOT NULL AND ((ex - ax) * (py - ay) - (ey - ay) * (px - ax)) * ((ex - ax) * (qy - ay) - (ey - ay) * (qx - ax)) < 0
   AND ((qx - px) * (ay - py) - (qy - py) * (ax - px)) * ((qx - px) * (ey - py) - (qy - py) * (ex - px)) < 0
  UNION SELECT pass, name FROM t, n WHERE i = 1 AND {IN_RING}
)
SELECT p.pass, coalesce(string_agg(DISTINCT name, ',' ORDER BY name), '') AS areas FROM (SELECT DISTINCT l_orderkey AS pass FROM lineitem) p LEFT JOIN h USING (pass) GROUP BY 1""")
def pass_areas(spark, sf):
    """The areas that each track crosses, by name, none at all included."""
    n, k = table(spark, sf, "nation"), F.col("n_nationkey")
    areas = n.select(F.col("n_name").alias("name"), F.array(star(k, (k % 5) * 2.0 + 1, F.floor(k / 5) * 2.0 + 1, 1.3, EIGHT)).alias("rings"))
    at = F.struct(F.col("l_linenumber").alias("i"), F.struct(((F.col("l_partkey") * 7 % 1009) / 100.0 + 0.00373).alias("lng"), ((F.col("l_suppkey") * 31 % 997) / 100.0 + 0.00119).alias("lat")).alias("at"))
    tracks = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("pass")).agg(F.transform(F.array_sort(F.collect_list(at)), lambda z: z["at"]).alias("track"))
    met = polygon_joins.meet(tracks, "pass", "track", areas, "name", "rings", touching=False).groupBy("pass").agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("areas"))
    return tracks.select("pass").join(met, "pass", "left").select("pass", F.coalesce("areas", F.lit("")).alias("areas"))


@query("x7_simplified_counts", "SELECT s_suppkey, (4 + CASE WHEN s_suppkey % 3 = 0 THEN 3 ELSE 0 END + CASE WHEN s_suppkey % 5 = 0 THEN 3 ELSE 0 END)::BIGINT AS points FROM supplier")
def simplified_counts(spark, sf):
    """Boxes whose sides have small waves and, on some, one or two peaks: only corners and peaks, with the two points beside each, are left."""
    k = F.col("s_suppkey")
    west, south = (k % 100).cast("double"), F.floor(k / 100).cast("double")
    at = lambda dx, dy: F.struct((west + dx).alias("lng"), (south + dy).alias("lat"))
    foot = [at(F.lit(i / 10), F.lit(0.0002 * (i % 2))) for i in range(9)]
    right = [at(F.lit(0.8), F.lit(i / 10)) if i != 4 else at(F.when(k % 3 == 0, 0.7).otherwise(0.7999), F.lit(0.4)) for i in range(1, 9)]
    top = [at(F.lit(0.8 - i / 10), F.lit(0.8)) if i != 4 else at(F.lit(0.4), F.when(k % 5 == 0, 0.65).otherwise(0.7998)) for i in range(1, 9)]
    left = [at(F.lit(0.0), F.lit(0.8 - i / 10)) for i in range(1, 8)]
    shapes = table(spark, sf, "supplier").select("s_suppkey", F.array(F.array(F.array(*foot, *right, *top, *left))).alias("shape"))
    return simplify.simplify(shapes, "s_suppkey", "shape", 0.001).select("s_suppkey", F.size(F.col("shape")[0][0]).cast("long").alias("points"))


def alert_areas(spark, sf: str, day: str) -> tuple[DataFrame, DataFrame]:
    """``alerts`` in force on a day; ``areas(identifier, rings)``: the polygons of each by priority of source.

    An alert's own circle comes before the townships that its description names, and those before counties.
    """
    start, o, k = F.lit(f"{day} 00:00:00").cast("timestamp_ntz"), table(spark, sf, "orders"), F.col("o_orderkey")
    named = F.concat(F.lit("T"), (k % 125).cast("string"), F.lit("、 C"), (k % 7).cast("string"), F.when(k % 4 > 0, F.concat(F.lit("; T"), (k % 125 + k % 4).cast("string"))).otherwise(""))
    circle = F.when(k % 5 == 0, F.format_string("%.2f,%.2f %.1f", 0.6 + (k % 7) * 0.25, 0.7 + (k % 11) * 0.2, 20.0 + (k % 13).cast("double")))
    alerts = o.filter(
        (F.col("o_orderdate") < start + F.expr("INTERVAL 1 DAY")) & (F.col("o_orderdate") >= start - F.expr("INTERVAL 2 DAY")) & (F.col("o_orderstatus") != "P")
    ).select(k.alias("identifier"), "o_orderdate", named.alias("area_desc"), circle.alias("circle"))
    names = alerts.select("identifier", F.explode(F.split("area_desc", r"\s*[/／、,，;；\n]\s*")).alias("name")).filter("name <> ''")
    s, n = F.col("s_suppkey"), F.col("n_nationkey")
    towns = table(spark, sf, "supplier").select(F.concat(F.lit("T"), s.cast("string")).alias("name"), star(s, (s % 10) * 0.25 + 0.3, F.floor(s / 10) % 10 * 0.25 + 0.3, 0.21, EIGHT).alias("ring"))
    counties = table(spark, sf, "nation").select(F.concat(F.lit("C"), n.cast("string")).alias("name"), star(n, (n % 5) * 0.5 + 0.4, F.floor(n / 5) * 0.5 + 0.4, 0.6, FIVE).alias("ring"))
    own = alerts.filter("circle IS NOT NULL").select("identifier", F.lit(0).alias("level"), geo.cap_circle(F.col("circle")).alias("ring"))
    found = lambda places, level: names.join(places, "name").select("identifier", F.lit(level).alias("level"), "ring")
    every = own.unionByName(found(towns, 1)).unionByName(found(counties, 2))
    best = every.groupBy("identifier").agg(F.min("level").alias("level"))
    return alerts, every.join(best, ["identifier", "level"]).select("identifier", F.array("ring").alias("rings"))


@query("a5_x7_alert_day")
def alert_day(spark, sf):
    """A day's alerts with their united and simplified areas as GeoJSON; ``a5_x7_alert_points`` holds the same unions against SQL."""
    alerts, areas = alert_areas(spark, sf, "1997-01-15")
    shapes = simplify.simplify(planar.union(areas, "identifier", "rings"), "identifier", "polygons", 0.001)
    geom = shapes.select("identifier", planar.multipolygon(F.col("polygons")).alias("geom"))
    return alerts.join(geom, "identifier", "left").select("identifier", "area_desc", tu.epoch_seconds(F.col("o_orderdate")).alias("effective_ts"), "geom").orderBy("effective_ts", "identifier")


_CIRCLE = "list_transform(range(32), lambda i: {'lng': lng + r * cos(i * 2 * pi() / 32) / cos(radians(lat)), 'lat': lat + r * sin(i * 2 * pi() / 32)})"


@query("a5_x7_alert_points", f"""
WITH o AS (SELECT o_orderkey AS k FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-13' AND o_orderdate < TIMESTAMP '1997-01-16' AND o_orderstatus <> 'P'),
c AS (SELECT k, round(0.7 + k % 11 * 0.2, 2) AS lng, round(0.6 + k % 7 * 0.25, 2) AS lat, (20 + k % 13) / 111.32 AS r FROM o WHERE k % 5 = 0),
names AS (SELECT k, 'T' || k % 125 AS name FROM o UNION SELECT k, 'C' || k % 7 FROM o UNION SELECT k, 'T' || (k % 125 + k % 4) FROM o),
places AS (
  SELECT 'T' || s_suppkey AS name, 1 AS level, {star_sql('s_suppkey', '(s_suppkey % 10 * 0.25 + 0.3)', '(s_suppkey // 10 % 10 * 0.25 + 0.3)', 0.21, EIGHT)} AS ring FROM supplier
  UNION ALL SELECT 'C' || n_nationkey, 2, {star_sql('n_nationkey', '(n_nationkey % 5 * 0.5 + 0.4)', '(n_nationkey // 5 * 0.5 + 0.4)', 0.6, FIVE)} FROM nation
), e AS (SELECT k, 0 AS level, {_CIRCLE} AS ring FROM c UNION ALL SELECT k, level, ring FROM names JOIN places USING (name)),
b AS (SELECT k, ring FROM e QUALIFY level = min(level) OVER (PARTITION BY k)), p AS ({grid_sql(30, 0.1)})
SELECT DISTINCT point, k AS identifier FROM b, p WHERE {IN_RING}""")
def alert_points(spark, sf):
    """Which places lie in the united area of which alert of the day."""
    _, areas = alert_areas(spark, sf, "1997-01-15")
    whole = planar.union(areas, "identifier", "rings").select("identifier", F.explode("polygons").alias("rings"))
    return polygon_joins.meet(grid(spark, 30, 0.1), "point", "way", whole, "identifier", "rings")
