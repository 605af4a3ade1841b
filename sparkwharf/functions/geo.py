"""Points, lines, rings and great circles as column expressions; geometry is WKT text beside plain longitude and latitude."""

from __future__ import annotations

from collections.abc import Callable
from math import cos, pi, sin

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM, KM_PER_DEGREE, KM_PER_NAUTICAL_MILE = 6371.0, 111.32, 1.852
SRID = "SRID=4326;"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(a))


def knots(km: Column, seconds: Column) -> Column:
    return km / KM_PER_NAUTICAL_MILE / F.nullif(seconds / F.lit(3600.0), F.lit(0.0))


def point_wkt(lng: Column, lat: Column, keep_zero: bool = True) -> Column:
    """Null without both coordinates; with ``keep_zero`` off a zero counts as missing, as some feeds mean it."""
    there = lng.isNotNull() & lat.isNotNull()
    if not keep_zero:
        there = there & (lng != 0) & (lat != 0)
    return F.when(there, F.format_string(SRID + "POINT(%.6f %.6f)", lng.cast("double"), lat.cast("double")))


def line_wkt(points: Column) -> Column:
    """From array<struct<lng, lat>>; null for fewer than two points."""
    text = F.array_join(F.transform(points, lambda p: F.format_string("%.6f %.6f", p["lng"].cast("double"), p["lat"].cast("double"))), ", ")
    return F.when(F.size(points) >= 2, F.concat(F.lit(SRID + "LINESTRING("), text, F.lit(")")))


def box_wkt(west: Column, south: Column, east: Column, north: Column) -> Column:
    w, s, e, n = (x.cast("double") for x in (west, south, east, north))
    return F.format_string(SRID + "POLYGON((%f %f, %f %f, %f %f, %f %f, %f %f))", w, s, e, s, e, n, w, n, w, s)


def circle_ring(lat: Column, lng: Column, radius_km: Column, segments: int = 32, least_km: float = 0.05) -> Column:
    """Closed ring array<struct<lng, lat>> around a point; small radii are raised to ``least_km``."""
    turns = [2 * pi / segments * (k % segments) for k in range(segments + 1)]
    ways = F.array(*[F.struct(F.lit(cos(t)).alias("x"), F.lit(sin(t)).alias("y")) for t in turns])
    r = F.greatest(radius_km, F.lit(least_km)) / KM_PER_DEGREE
    at = F.struct(lat.alias("lat"), lng.alias("lng"), r.alias("r"), F.cos(F.radians(lat)).alias("narrow"))
    ring = lambda c: F.transform(ways, lambda w: F.struct((c["lng"] + c["r"] * w["x"] / c["narrow"]).alias("lng"), (c["lat"] + c["r"] * w["y"]).alias("lat")))
    return let(at, ring)


def cap_circle(text: Column) -> Column:
    """The ring of ``lat,lng radius``."""
    form = r"^\s*(-?[\d.]+)\s*,\s*(-?[\d.]+)\s+([\d.]+)\s*$"
    numbers = F.struct(*[F.regexp_extract(text, form, i).try_cast("double").alias(name) for i, name in enumerate(("lat", "lng", "km"), 1)])
    return let(numbers, lambda c: F.when(c["km"].isNotNull(), circle_ring(c["lat"], c["lng"], c["km"])))


def cap_polygon(text: Column) -> Column:
    """Closed ring of ``lat,lng lat,lng ...``; null for fewer than three points."""
    pairs = F.transform(F.filter(F.split(F.trim(text), r"\s+"), lambda p: p.rlike(r"^-?[\d.]+,-?[\d.]+$")), lambda p: F.split(p, ","))
    points = F.transform(pairs, lambda p: F.struct(p[1].cast("double").alias("lng"), p[0].cast("double").alias("lat")))
    closed = lambda p: F.when(F.get(p, F.lit(0)) == F.element_at(p, -1), p).otherwise(F.concat(p, F.slice(p, 1, 1)))
    return let(points, lambda p: F.when(F.size(p) >= 3, closed(p)))


def ring_wkt(ring: Column) -> Column:
    text = F.array_join(F.transform(ring, lambda p: F.format_string("%.6f %.6f", p["lng"], p["lat"])), ", ")
    return F.when(ring.isNotNull(), F.concat(F.lit(SRID + "POLYGON(("), text, F.lit("))")))


def multi_wkt(rings: Column) -> Column:
    """MULTIPOLYGON of an array of rings."""
    one = lambda r: F.concat(F.lit("(("), F.array_join(F.transform(r, lambda p: F.format_string("%.6f %.6f", p["lng"], p["lat"])), ", "), F.lit("))"))
    return F.concat(F.lit(SRID + "MULTIPOLYGON("), F.array_join(F.transform(rings, one), ", "), F.lit(")"))


def in_ring(lng: Column, lat: Column, ring: Column) -> Column:
    """Ray casting: whether the point lies in the closed ring."""
    at = F.struct(lng.alias("lng"), lat.alias("lat"), ring.alias("ring"))
    crosses = lambda p, a, b: ((a["lat"] > p["lat"]) != (b["lat"] > p["lat"])) & (
        p["lng"] < (b["lng"] - a["lng"]) * (p["lat"] - a["lat"]) / (b["lat"] - a["lat"]) + a["lng"]
    )
    # the last point has none behind it, so it closes nothing
    sides = lambda p: F.zip_with(p["ring"], F.slice(p["ring"], F.lit(2), F.size(p["ring"])), lambda a, b: F.coalesce(crosses(p, a, b), F.lit(False)))
    return let(at, lambda p: F.size(F.filter(sides(p), lambda c: c)) % 2 == 1)


def geojson_points(text: Column) -> Column:
    """Coordinates of a GeoJSON LineString as array<struct<lng, lat>>."""
    parsed = F.from_json(text, "type string, coordinates array<array<double>>")
    return F.when(parsed["type"] == "LineString", F.transform(parsed["coordinates"], lambda c: F.struct(c[0].alias("lng"), c[1].alias("lat"))))


def project_on_line(lng: Column, lat: Column, line: Column) -> Column:
    """struct<km_off, along> of the nearest place on the polyline: distance, and share of its length before that place."""
    flat = F.cos(F.radians(lat))
    x, y = (lambda p: (p["lng"] - lng) * flat), (lambda p: p["lat"] - lat)
    pairs = F.zip_with(F.slice(line, F.lit(1), F.size(line) - 1), F.slice(line, F.lit(2), F.size(line) - 1), lambda a, b: F.struct(x(a).alias("ax"), y(a).alias("ay"), x(b).alias("bx"), y(b).alias("by")))
    length = lambda s: F.sqrt(F.pow(s["bx"] - s["ax"], 2) + F.pow(s["by"] - s["ay"], 2))
    share = lambda s: F.when(length(s) == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(s["ax"] * (s["bx"] - s["ax"]) + s["ay"] * (s["by"] - s["ay"])) / F.pow(length(s), 2)))
    )
    off = lambda s: F.sqrt(F.pow(s["ax"] + share(s) * (s["bx"] - s["ax"]), 2) + F.pow(s["ay"] + share(s) * (s["by"] - s["ay"]), 2))
    start = F.struct(F.lit(float("inf")).alias("off"), F.lit(0.0).alias("at"), F.lit(0.0).alias("done"))
    best = F.aggregate(
        pairs,
        start,
        lambda acc, s: F.struct(
            F.least(acc["off"], off(s)).alias("off"),
            F.when(off(s) < acc["off"], acc["done"] + share(s) * length(s)).otherwise(acc["at"]).alias("at"),
            (acc["done"] + length(s)).alias("done"),
        ),
    )
    return F.struct((best["off"] * KM_PER_DEGREE).alias("km_off"), F.when(best["done"] > 0, best["at"] / best["done"]).otherwise(F.lit(0.0)).alias("along"))


def cell(lng: Column, lat: Column, step: float) -> Column:
    return F.struct(F.floor(lng / step).alias("cx"), F.floor(lat / step).alias("cy"))


def near_cells(lng: Column, lat: Column, step: float) -> Column:
    """The 3 x 3 cells around a point: candidates within one step lie in them."""
    around = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    return F.transform(around, lambda d: F.struct((F.floor(lng / step) + d["dx"]).alias("cx"), (F.floor(lat / step) + d["dy"]).alias("cy")))


def wrap_longitude(lng: Column) -> Column:
    """0..360 to -180..180."""
    return F.when(lng > 180, lng - 360).otherwise(lng)


def pixel_to_lonlat(px: Column, py: Column, west: float, north: float, dx: float, dy: float) -> Column:
    return F.struct((F.lit(west) + px * dx).alias("lng"), (F.lit(north) - py * dy).alias("lat"))


def within_gate(dx: Column, dy: Column, most: float) -> Column:
    """Whether a control point deviates by no more than the gate."""
    return F.sqrt(dx * dx + dy * dy) <= most


def quantise(value: Column, low: Column, high: Column) -> Column:
    """0..255 between bounds; 128 for a constant field, null for NaN."""
    scaled = F.round((value - low) / F.nullif(high - low, F.lit(0.0)) * 255)
    # greatest() and least() pass over nulls, so a constant field is told apart first
    clamped = F.when(scaled.isNull(), F.lit(128.0)).otherwise(F.least(F.greatest(scaled, F.lit(0.0)), F.lit(255.0)))
    return F.when(F.isnan(value) | value.isNull(), None).otherwise(clamped.cast("int"))


def orbit_class(mean_motion: Column) -> Column:
    """By the mean altitude that Kepler's third law gives for revolutions a day."""
    axis = F.pow(F.lit(398600.4418) * F.pow(F.lit(86400.0) / (mean_motion * 2 * pi), 2), F.lit(1 / 3))
    altitude = axis - EARTH_KM
    return F.when(altitude < 2000, "LEO").when(altitude < 35000, "MEO").when(altitude < 36600, "GEO").otherwise("HEO")


def inertial_to_geodetic(x: Column, y: Column, z: Column, julian_day: Column) -> Column:
    """Inertial km to struct<lat, lng, alt_km> on a sphere, turned by Greenwich mean sidereal time."""
    d = julian_day - 2451545.0
    sidereal = F.radians(F.pmod(F.lit(280.46061837) + F.lit(360.98564736629) * d, F.lit(360.0)))
    r = F.sqrt(x * x + y * y + z * z)
    lng = F.pmod(F.degrees(F.atan2(y, x) - sidereal) + 180, F.lit(360.0)) - 180
    return F.struct(F.degrees(F.asin(z / r)).alias("lat"), lng.alias("lng"), (r - EARTH_KM).alias("alt_km"))


class TransverseMercator:
    """A zone of the transverse Mercator projection as expressions, by Krüger's series to the fourth order of the third flattening."""

    def __init__(self, meridian: float, scale: float = 0.9999, false_east: float = 250_000.0, false_north: float = 0.0, axis: float = 6378137.0, flattening: float = 1 / 298.257222101):
        n = flattening / (2 - flattening)
        self.meridian, self.false_east, self.false_north, self.n = meridian, false_east, false_north, n
        self.radius = scale * axis / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
        self.ahead = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280)
        self.back = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280)
        self.latitude = (2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630)

    def forward(self, lng: Column, lat: Column) -> Column:
        """struct<x, y> in metres."""
        e = 2 * self.n**0.5 / (1 + self.n)
        s, d = F.sin(F.radians(lat)), F.radians(lng - self.meridian)
        t = F.sinh(F.atanh(s) - F.lit(e) * F.atanh(F.lit(e) * s))
        xi, eta = F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(1 + t * t))
        east = eta + sum((F.lit(a) * F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) for j, a in enumerate(self.ahead, 1)), F.lit(0.0))
        north = xi + sum((F.lit(a) * F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) for j, a in enumerate(self.ahead, 1)), F.lit(0.0))
        return F.struct((east * self.radius + self.false_east).alias("x"), (north * self.radius + self.false_north).alias("y"))

    def inverse(self, x: Column, y: Column) -> Column:
        """struct<lng, lat> in degrees."""
        xi, eta = (y - self.false_north) / self.radius, (x - self.false_east) / self.radius
        north = xi - sum((F.lit(b) * F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) for j, b in enumerate(self.back, 1)), F.lit(0.0))
        east = eta - sum((F.lit(b) * F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) for j, b in enumerate(self.back, 1)), F.lit(0.0))
        chi = F.asin(F.sin(north) / F.cosh(east))
        lat = chi + sum((F.lit(d) * F.sin(chi * (2 * j)) for j, d in enumerate(self.latitude, 1)), F.lit(0.0))
        return F.struct((F.degrees(F.atan2(F.sinh(east), F.cos(north))) + self.meridian).alias("lng"), F.degrees(lat).alias("lat"))
