import pytest
from pyspark.sql import functions as F

from sparkwharf.functions import geo
from sparkwharf.sources import shapefiles as m

BOX = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)]
HOLE, ISLAND = [(1.0, 1.0), (8.0, 1.0), (8.0, 8.0), (1.0, 8.0)], [(3.0, 3.0), (5.0, 3.0), (5.0, 5.0)]


def turned(rings):
    """Each ring from its smallest point on, shells against the clock."""
    out = []
    for k, r in enumerate(rings):
        r = r[::-1] if (m._area2(r) > 0) != (k == 0) else r
        at = r.index(min(r))
        out.append(r[at:] + r[:at])
    return out


def test_polygons_holes_and_fields(spark):
    rows = [({"Name": "翡翠水庫", "area": "12.5"}, [[BOX, HOLE], [ISLAND]]), ({"Name": "", "area": "0"}, None), ({"Name": "é", "area": "7"}, [[ISLAND]])]
    files = spark.createDataFrame([("a.zip", m.shapefile_bytes(rows)), ("b.zip", m.shapefile_bytes(rows[2:]))], "path string, content binary")
    got = {(r["path"], r["record"]): r for r in m.shapefile_rows(files).collect()}
    assert {k: dict(r["fields"]) for k, r in got.items()} == {("a.zip", 0): rows[0][0], ("a.zip", 1): rows[1][0], ("a.zip", 2): rows[2][0], ("b.zip", 0): rows[2][0]}
    shape = lambda k: None if got[k]["polygons"] is None else sorted(turned([[(p["x"], p["y"]) for p in ring] for ring in rings]) for rings in got[k]["polygons"])
    assert shape(("a.zip", 1)) is None and shape(("b.zip", 0)) == [turned([ISLAND])]
    assert shape(("a.zip", 0)) == sorted([turned([BOX, HOLE]), turned([ISLAND])])


def test_other_kinds_raise(spark):
    data = m.shapefile_bytes([({"a": "1"}, [[BOX]])])
    import io
    import zipfile

    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shp, dbf = bytearray(z.read("areas.shp")), z.read("areas.dbf")
    shp[108:112] = (3).to_bytes(4, "little")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("x.SHP", bytes(shp))
        z.writestr("x.DBF", dbf)
    with pytest.raises(Exception, match="kind 3"):
        m.shapefile_rows(spark.createDataFrame([("c", out.getvalue())], "path string, content binary")).collect()


def test_transverse_mercator(spark):
    zone = geo.TransverseMercator(121.0)
    places = [(121.0, 23.5), (120.2, 22.0), (121.98, 25.3), (119.3, 23.6), (122.5, 10.0), (118.0, 45.0)]
    df = spark.createDataFrame(places, "lng double, lat double").withColumn("p", zone.forward(F.col("lng"), F.col("lat")))
    for r in df.withColumn("q", zone.inverse(F.col("p.x"), F.col("p.y"))).collect():
        assert abs(r["q"]["lng"] - r["lng"]) < 1e-10 and abs(r["q"]["lat"] - r["lat"]) < 1e-10
    on = df.filter("lng = 121").first()["p"]
    assert abs(on["x"] - 250_000) < 1e-6
    # on the meridian the northing is the scaled arc from the equator, here integrated in small steps
    import math

    a, f = 6378137.0, 1 / 298.257222101
    e2, steps = f * (2 - f), 200_000
    arc = sum(a * (1 - e2) / (1 - e2 * math.sin((i + 0.5) * math.radians(23.5) / steps) ** 2) ** 1.5 for i in range(steps)) * math.radians(23.5) / steps
    assert abs(on["y"] - 0.9999 * arc) < 1e-4
