"""Queries over gridded and projected files: rows of a table are written in the format, found through an index, and read by ranges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from sparkwharf.functions import geo
from sparkwharf.plans.register import query, table
from sparkwharf.sources import files, grids, renders, shapefiles
from sparkwharf.sources.shared import folder

#: Lead times in a file, six hours apart.
LEADS = 8


def _netcdf(row: dict) -> bytes:
    """Fine dust and temperature of a file's vectors: one lead time each, as 8 x 8 fields."""
    rows = sorted(row["rows"], key=lambda r: r["vec_id"])
    field = np.array([r["embedding"] for r in rows], "f4").reshape(-1, 8, 8)
    leads = np.array([r["vec_id"] % LEADS * 6 for r in rows], "i4")
    axes = ["forecast_period", "latitude", "longitude"]
    variables = {
        "forecast_period": (axes[:1], leads, {"units": "hours"}), "latitude": (axes[1:2], 25.0 - np.arange(8) * 0.5, {}), "longitude": (axes[2:], 119.0 + np.arange(8) * 0.5, {}),
        "pm2p5": (axes, field * np.float32(2.0**-30), {}), "t2m": (axes, np.floor(field.astype("f8") * 1024).astype("i2"), {"scale_factor": np.array([0.25]), "add_offset": np.array([280.0]), "_FillValue": np.array([0], "i2")}),
    }
    return renders.netcdf_bytes([(axes[0], None if row["file"] % 2 else len(rows)), (axes[1], 8), (axes[2], 8)], variables, version=(1, 2, 5)[row["file"] % 3])


@query("s16_s28_netcdf_leads", f"""
WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
c AS (
  SELECT vec_id // {LEADS} AS file, 'pm2p5' AS variable, vec_id % {LEADS} * 6.0 AS lead, 25.0 - i // 8 * 0.5 AS lat, 119.0 + i % 8 * 0.5 AS lng, x / 1073741824.0 * 1e9 AS value FROM e
  UNION ALL SELECT vec_id // {LEADS}, 't2m', vec_id % {LEADS} * 6.0, 25.0 - i // 8 * 0.5, 119.0 + i % 8 * 0.5, CASE WHEN floor(x * 1024) <> 0 THEN floor(x * 1024) * 0.25 + 280 END FROM e
)
SELECT file, variable, lead, lat, lng, round(value, 6) AS value FROM c""")
def netcdf_leads(spark, sf):
    """Every variable and lead time, a slab a row of the index and each read by its own range. Fine dust is scaled to micrograms."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding", F.floor(F.col("vec_id") / LEADS).alias("file"))
    rows = e.groupBy("file").agg(F.collect_list(F.struct("vec_id", "embedding")).alias("rows"))  # LEADS rows a file
    written = renders.write_files(rows, folder(spark, "netcdf"), lambda r: f"cams-{r['file']}.nc", _netcdf)
    cells = grids.netcdf_cells(grids.netcdf_slabs(written).filter("variable IN ('pm2p5', 't2m')"))
    scaled = F.col("value") * F.when(F.col("variable") == "pm2p5", 1e9).otherwise(1.0)
    return cells.select(F.regexp_extract("path", r"cams-(\d+)\.nc$", 1).cast("long").alias("file"), "variable", "lead", "lat", "lng", F.round(scaled, 6).alias("value"))


def _grib(row: dict) -> bytes:
    """A message a vector: 8 x 8 tenths, without those that a seventh of the numbers stand for; every tenth field is constant."""
    out = []
    for r in sorted(row["rows"], key=lambda r: r["vec_id"]):
        x = np.floor(np.array(r["embedding"], "f8").reshape(8, 8) * 1000)
        x = np.full((8, 8), float(r["vec_id"])) if r["vec_id"] % 10 == 0 else np.where(x % 7 == 0, np.nan, x) / 10
        out.append(renders.grib_bytes(x, (21.0, 0.25), (119.0, 0.25), category=2, parameter=2 + r["vec_id"] % 2, level=10.0, lead_hours=r["vec_id"] % 5 * 3, bits=14, decimal=1))
    return b"".join(out)


@query("s15_g34_grib_digest", """
WITH e AS (SELECT vec_id, floor(unnest(embedding)::DOUBLE * 1000) AS x FROM embeddings), v AS (SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN vec_id::DOUBLE WHEN x % 7 <> 0 THEN x / 10 END AS value FROM e)
SELECT vec_id // 20 AS file, (2 + vec_id % 2)::INT AS parameter, vec_id % 5 * 3.0 AS lead, round(max(value), 6) AS max, round(min(value), 6) AS min, CAST(sum(CAST(round(value * 10) AS BIGINT)) AS BIGINT) AS tenths, count(value) AS n, count(*) - count(value) AS missing FROM v GROUP BY 1, 2, 3""")
def grib_digest(spark, sf):
    """Digests of wind components: messages found through the index, each read by its own range."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding", F.floor(F.col("vec_id") / 20).alias("file"))
    rows = e.groupBy("file").agg(F.collect_list(F.struct("vec_id", "embedding")).alias("rows"))  # 20 rows a file
    written = renders.write_files(rows, folder(spark, "grib"), lambda r: f"gfs-{r['file']}.grib2", _grib)
    cells = grids.grib_cells(grids.grib_fields(written).filter("category = 2 AND parameter IN (2, 3)"))
    per = cells.groupBy(F.regexp_extract("path", r"gfs-(\d+)\.grib2$", 1).cast("long").alias("file"), "parameter", "lead")
    return per.agg(F.round(F.max("value"), 6).alias("max"), F.round(F.min("value"), 6).alias("min"), F.sum(F.round(F.col("value") * 10).cast("long")).alias("tenths"), F.count("value").alias("n"), F.count_if(F.col("value").isNull()).alias("missing"))


ZONE = geo.TransverseMercator(121.0)


@query("s17_shapefile", """
SELECT s_suppkey, trim(s_name) AS name, 121 + s_suppkey % 100 / 100.0 AS lng, 22.5 + s_suppkey % 30 / 10.0 AS lat FROM supplier
UNION ALL SELECT s_suppkey, trim(s_name), 121 + s_suppkey % 100 / 100.0 + 0.05, 22.5 + s_suppkey % 30 / 10.0 FROM supplier
UNION ALL SELECT s_suppkey, trim(s_name), 121 + s_suppkey % 100 / 100.0, 22.5 + s_suppkey % 30 / 10.0 + 0.03 FROM supplier""")
def shapefile(spark, sf):
    """Triangles projected to metres and written as zipped shapefiles; what is read is turned back to degrees."""
    west, south = F.lit(121.0) + F.col("s_suppkey") % 100 / F.lit(100.0), F.lit(22.5) + F.col("s_suppkey") % 30 / F.lit(10.0)
    ring = F.array(ZONE.forward(west, south), ZONE.forward(west + 0.05, south), ZONE.forward(west, south + 0.03))
    s = table(spark, sf, "supplier").select(F.floor(F.col("s_suppkey") / 500).alias("file"), F.struct("s_suppkey", "s_name", ring.alias("ring")).alias("r"))
    rows = s.groupBy("file").agg(F.collect_list("r").alias("rows"))  # 500 rows a file
    content = lambda row: shapefiles.shapefile_bytes([({"Key": str(r["s_suppkey"]), "Name": r["s_name"]}, [[[(p["x"], p["y"]) for p in r["ring"]]]]) for r in row["rows"]])
    written = renders.write_files(rows, folder(spark, "shapefiles"), lambda r: f"areas-{r['file']}.zip", content)
    paths = [r["path"] for r in written.select("path").collect()]  # a row a file
    read = shapefiles.shapefile_rows(files.binary_files(spark, paths))
    points = read.select(F.col("fields")["Key"].cast("long").alias("s_suppkey"), F.col("fields")["Name"].alias("name"), F.explode(F.flatten(F.flatten("polygons"))).alias("p"))
    back = points.withColumn("q", ZONE.inverse(F.col("p.x"), F.col("p.y")))
    return back.select("s_suppkey", "name", F.round("q.lng", 7).alias("lng"), F.round("q.lat", 7).alias("lat"))
