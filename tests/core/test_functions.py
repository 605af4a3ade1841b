import base64
import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sparkwharf.functions import geo
from sparkwharf.functions import text as tx
from sparkwharf.functions import timeutil as tu


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_roc_and_periods(spark):
    r = one(
        spark, a=tu.roc_date(F.lit("113.05.02")), b=tu.roc_date(F.lit("1130502")), c=tu.roc_date(F.lit("99/1/3")), d=tu.roc_date(F.lit("junk")), e=tu.roc_year_month(F.lit("11305")), f=tu.roc_year_month(F.lit(" 011305")),
        g=tu.roc_year_month(F.lit("11313")), h=tu.clock_seconds(F.lit("00:30"), F.lit(80000)), i=tu.period_end(F.lit("2023-12-20").cast("date"), F.lit(1), F.lit(5)),
    )
    assert tuple(r) == (date(2024, 5, 2), date(2024, 5, 2), date(2010, 1, 3), None, date(2024, 5, 1), date(2024, 5, 1), None, 88200, date(2024, 1, 5))


def test_times(spark):
    ts = F.lit("2024-01-05 23:47:30.5").cast("timestamp_ntz")
    r = one(spark, e=tu.epoch_seconds(ts), k=tu.time_key(tu.floor_minutes(ts, 15)), d=tu.local_date(ts), c=F.date_format(tu.model_cycle(F.lit("2024-01-05 03:00:00").cast("timestamp_ntz")), "dd HH"), g=F.date_format(tu.day_hour_minute(F.lit("312300Z"), F.lit("2024-02-01").cast("date")), "yyyy-MM-dd HH:mm"))
    assert tuple(r) == (1704498451, "2024-01-05T23:45", date(2024, 1, 6), "04 18", "2024-01-31 23:00")
    assert tu.refresh_days(datetime(2024, 1, 5, 17)) == [date(2024, 1, 5), date(2024, 1, 6)]


def slow_simhash(text):
    grams = [text] if len(text) == 1 else [text[i : i + 2] for i in range(len(text) - 1)]
    if not text:
        return 0
    hs = [int(hashlib.md5(g.encode()).hexdigest()[:16], 16) for g in grams]
    out = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    return out - (1 << 64) if out >> 63 else out


@pytest.mark.parametrize("text", ["", "a", "ab", "heavy rain warning", "大雨特報發布", "x" * 50])
def test_simhash(spark, text):
    assert one(spark, s=tx.simhash64(F.lit(text))).s == slow_simhash(text)


def test_text(spark):
    link = "https://n.example/rss/articles/" + base64.urlsafe_b64encode(b"\x08\x13\x22\x1fhttps://a.example/b?c=1\xd2\x01\x00").decode().rstrip("=")
    r = one(
        spark, url=tx.normal_url(F.lit("HTTPS://Www.Example.com/A/b/?utm_source=x&id=3&FBCLID=1#f")), none=tx.normal_url(F.lit("not a url")), red=tx.redirect_target(F.lit(link)), title=tx.clean_title(F.lit("[Live] 台北 Heavy_Rain! — Daily News")),
        num=tx.number(F.lit("1,234.5%")), no=tx.number(F.lit("休市")), signed=tx.to_signed(F.lit("18446744073709551615").cast("decimal(20,0)")), unsigned=tx.to_unsigned(F.lit(-1).cast("long")).cast("string"), moji=tx.is_mojibake(F.lit("ok"), F.lit("Рђ")), toks=tx.tokens(F.lit(" 台北市、 新北市 /;桃園市")),
        km=tx.kilometre(F.lit("12K+345")), km2=tx.kilometre(F.lit("7.5K")), road=tx.road_name(F.lit(" 省道台十七甲線")), way=tx.road_direction(F.lit(" 北向")), day=tu.roc_year_month(F.lit("1130712")), rank=tx.intensity_rank(F.lit("5強")), cnt=tx.report_count(F.lit("saw 12 ships"), "(\\d+) ships"), cnt2=tx.report_count(F.lit("saw none"), "(\\d+) ships"), b=tx.human_bytes(F.lit(1536)), html=tx.strip_html(F.lit("<p>a&nbsp;<b>b</b></p><script>x</script>")),
        share=tx.without_share(F.lit("Buoy 7 45%")), lab=tx.labelled(F.lit("9"), {"1": "one"}, "other"),
    )
    assert tuple(r) == ("https://www.example.com/A/b?id=3", None, "https://a.example/b?c=1", "live臺北heavyrain", 1234.5, None, -1, "18446744073709551615", True, ["台北市", "新北市", "桃園市"], 12.345, None, "省道台107甲", "N", date(2024, 7, 12), 6, 12, None, "1.5 KB", "a b", "BUOY 7", "other")


def test_geometry(spark):
    ring = geo.cap_polygon(F.lit("0,0 0,10 10,10 10,0"))
    r = one(
        spark, n=F.size(geo.cap_circle(F.lit("24.0,121.0 0"))), closed=F.size(ring), few=geo.cap_polygon(F.lit("0,0 1,1")), inside=geo.in_ring(F.lit(5.0), F.lit(5.0), ring), out=geo.in_ring(F.lit(15.0), F.lit(5.0), ring), zero=geo.point_wkt(F.lit(0.0), F.lit(1.0), keep_zero=False), p=geo.point_wkt(F.lit(0.0), F.lit(1.0)),
        lon=geo.wrap_longitude(F.lit(270.0)), q=geo.quantise(F.lit(5.0), F.lit(5.0), F.lit(5.0)), nan=geo.quantise(F.lit(float("nan")), F.lit(0.0), F.lit(1.0)), leo=geo.orbit_class(F.lit(15.5)), geo_=geo.orbit_class(F.lit(1.0027)), g=F.size(geo.geojson_points(F.lit('{"type":"LineString","coordinates":[[1,2],[3,4]]}'))), mw=geo.multi_wkt(F.array(ring)).startswith("SRID=4326;MULTIPOLYGON(((0.000000 0.000000"), gate=geo.within_gate(F.lit(3.0), F.lit(4.0), 5),
        px=geo.pixel_to_lonlat(F.lit(10), F.lit(5), 120.0, 25.0, 0.1, 0.1)["lat"],
    )
    assert tuple(r) == (33, 5, None, True, False, None, "SRID=4326;POINT(0.000000 1.000000)", -90.0, 128, None, "LEO", "GEO", 2, True, True, 24.5)
    back = one(spark, s=geo.inertial_to_geodetic(F.lit(6771.0), F.lit(0.0), F.lit(0.0), F.lit(2451545.0))).s
    assert abs(back.lat) < 1e-9 and abs(back.alt_km - 400) < 1e-6 and abs(back.lng - (360 - 280.46061837)) < 1e-6
    assert abs(one(spark, d=geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))).d - 111.19) < 0.01


def test_rings_are_worked_out_once():
    """A ring's text is taken apart once, however often the ring is named."""
    assert str(geo.cap_polygon(F.col("x"))).count("split") <= 2
    ring = str(geo.in_ring(F.col("a"), F.col("b"), geo.cap_polygon(F.col("x"))))
    assert ring.count("trim") == 1
    assert str(geo.cap_circle(F.col("x"))).count("regexp_extract") == 3
