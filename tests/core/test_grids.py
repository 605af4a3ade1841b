import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwharf.sources import grids as m
from sparkwharf.sources import renders

LATS, LNGS = np.array([10.0, 10.5, 11.0]), np.array([119.0, 120.0, 121.0, 122.0])


def write(path, **files):
    for name, data in files.items():
        (path / name).write_bytes(data)


def cells(rows, *keys):
    return {tuple(r[k] for k in (*keys, "lat", "lng")): r["value"] for r in rows}


@pytest.mark.parametrize("version", [1, 2, 5])
@pytest.mark.parametrize("grows", [False, True])
def test_netcdf_by_lead(spark, tmp_path, version, grows):
    rng = np.random.default_rng(version)
    wind = rng.normal(size=(4, 3, 4)).astype("f4")
    wind[1, 2, 3] = np.nan
    dust = rng.integers(-300, 300, (4, 3, 4)).astype("i2")
    still = rng.normal(size=(3, 4))
    variables = {
        "time": (["time"], np.array([0, 6, 12, 24], "i4"), {"units": "hours"}),
        "latitude": (["latitude"], LATS, {}), "longitude": (["longitude"], LNGS.astype("f4"), {}),
        "wind": (["time", "latitude", "longitude"], wind, {}),
        "dust": (["time", "latitude", "longitude"], dust, {"scale_factor": np.array([0.5]), "add_offset": np.array([3.0]), "_FillValue": np.array([dust[2, 1, 1]], "i2")}),
        "land": (["latitude", "longitude"], still, {"note": "é"}), "other": (["time"], np.arange(4, dtype="i1"), {}),
    }
    write(tmp_path, a_nc=renders.netcdf_bytes([("time", None if grows else 4), ("latitude", 3), ("longitude", 4)], variables, version))
    index = m.netcdf_slabs(m.listed_files(spark, str(tmp_path)))
    assert {(r["variable"], r["lead"], r["unit"]) for r in index.collect()} == {(v, t, "hours") for v in ("wind", "dust") for t in (0.0, 6.0, 12.0, 24.0)} | {("land", 0.0, "")}
    got = cells(m.netcdf_cells(index.filter("lead IN (0, 12) OR variable = 'wind'")).collect(), "variable", "lead")
    want = {}
    for i, lead in enumerate([0.0, 6.0, 12.0, 24.0]):
        for j, lat in enumerate(LATS):
            for k, lng in enumerate(LNGS):
                want["wind", lead, lat, lng] = None if np.isnan(wind[i, j, k]) else float(wind[i, j, k])
                if lead in (0, 12):
                    want["dust", lead, lat, lng] = None if dust[i, j, k] == dust[2, 1, 1] else dust[i, j, k] * 0.5 + 3
                if lead == 0:
                    want["land", 0.0, lat, lng] = still[j, k]
    assert got == want


def test_netcdf_other_dimensions_and_long_headers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(m, "HEAD", 64)
    x = np.arange(2 * 3 * 2 * 2, dtype="f8").reshape(2, 3, 2, 2)
    dims = [("forecast_reference_time", 2), ("forecast_period", 3), ("lat", 2), ("lon", 2)]
    data = renders.netcdf_bytes(dims, {"lat": (["lat"], np.array([1.0, 0.0]), {"text": "x" * 5000}), "lon": (["lon"], np.array([5.0, 6.0]), {}), "v": ([d for d, _ in dims], x, {})})
    write(tmp_path, b_nc=data)
    rows = m.netcdf_cells(m.netcdf_slabs(m.listed_files(spark, str(tmp_path)))).collect()
    assert cells(rows, "lead") == {(float(i), [1.0, 0.0][j], [5.0, 6.0][k]): x[0, i, j, k] for i in range(3) for j in range(2) for k in range(2)}
    # as a stream that was never closed, which doesn't state its records
    one = {"lat": (["lat"], np.array([1.0]), {}), "lon": (["lon"], np.array([5.0]), {}), "v": (["time", "lat", "lon"], np.arange(7, dtype="f4").reshape(7, 1, 1), {})}
    open_end = renders.netcdf_bytes([("time", None), ("lat", 1), ("lon", 1)], one)
    write(tmp_path, b_nc=open_end[:4] + b"\xff" * 4 + open_end[8:])
    assert sorted(r["value"] for r in m.netcdf_cells(m.netcdf_slabs(m.listed_files(spark, str(tmp_path)))).collect()) == list(range(7))


def test_what_is_no_grid(spark, tmp_path):
    write(tmp_path, junk=b"no such thing", cut=b"CDF\x01\0\0\0\0\0\0\0\x0a\0\0\0\x05")
    for name, said in (("junk", "no NetCDF"), ("cut", "cut off")):
        with pytest.raises(Exception, match=said):
            m.netcdf_slabs(m.listed_files(spark, str(tmp_path), name)).collect()
    with pytest.raises(Exception, match="no GRIB2"):
        m.grib_fields(m.listed_files(spark, str(tmp_path), "junk")).collect()
    assert m.grib_fields(m.listed_files(spark, str(tmp_path), "none*")).collect() == []


def test_grib_fields_and_cells(spark, tmp_path):
    rng = np.random.default_rng(7)
    fields = []
    for i, (bits, decimal, missing) in enumerate([(12, 0, 0.0), (7, 2, 0.3), (1, 0, 0.0), (16, -1, 0.0), (31, 3, 0.5), (8, 0, 0.2)]):
        v = rng.integers(-(1 << (bits - 2)), 1 << (bits - 2), (5, 7)) / 10.0**decimal if bits > 1 else rng.integers(0, 2, (5, 7)).astype(float)
        v[rng.random((5, 7)) < missing] = np.nan
        fields.append((v, {"lats": (24.0, -0.25) if i % 2 else (-3.0, 0.5), "lngs": (119.5, 0.25), "category": 2, "parameter": i, "level": 10.0 + i * 0.5, "lead_hours": 3 * i, "bits": bits, "decimal": decimal}))
    fields.append((np.full((2, 2), -4.0), {"lats": (0.0, 1.0), "lngs": (0.0, 1.0), "category": 0, "parameter": 99, "level": 2.0, "lead_hours": 0}))
    fields.append((np.full((2, 2), np.nan), {"lats": (0.0, 1.0), "lngs": (0.0, 1.0), "category": 0, "parameter": 98, "level": 2.0, "lead_hours": 0}))
    write(tmp_path, a=b"".join(renders.grib_bytes(v, **k) for v, k in fields[:4]), b=b"".join(renders.grib_bytes(v, **k) for v, k in fields[4:]))
    index = m.grib_fields(m.listed_files(spark, str(tmp_path)))
    got = {(r["parameter"], r["level"], r["lead"], r["bits"]) for r in index.collect()}
    assert got == {(k["parameter"], k["level"], float(k["lead_hours"]), k.get("bits", 0)) for _, k in fields}
    assert {r["reference"] for r in index.collect()} == {"2024-01-01 00:00:00"}
    found = cells(m.grib_cells(index).collect(), "parameter")
    want = {(k["parameter"], k["lats"][0] + j * k["lats"][1], k["lngs"][0] + i * k["lngs"][1]): None if np.isnan(v[j, i]) else v[j, i] for v, k in fields for j in range(v.shape[0]) for i in range(v.shape[1])}
    assert found.keys() == want.keys()
    assert all((a is None) == (b is None) and (a is None or abs(a - b) < 1e-9 * max(1, abs(b))) for a, b in ((found[k], want[k]) for k in want))
    assert m.grib_cells(index.filter("parameter = 99")).agg(F.min("value"), F.max("value"), F.count("value")).first()[:] == (-4.0, -4.0, 4)


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 24, 32])
def test_bits(bits):
    x = np.random.default_rng(bits).integers(0, 1 << bits, 53)
    assert m.unpacked(renders.packed(x, bits), bits, 53).tolist() == x.tolist()
