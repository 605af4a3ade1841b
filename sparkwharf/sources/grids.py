"""Gridded forecasts: NetCDF classic files and GRIB2 messages, by an index first and byte ranges after.

An index is a table, a row a slab (NetCDF: one variable at one lead time) or a field (GRIB2), with where its bytes lie. It is made by reading
headers only. What a query wants is a filter on the index; only the ranges of the rows that are left are read, each by one
task, so a file of many gigabytes is neither held nor read as a whole. Files are opened through Arrow's file systems by the
addresses that Spark lists, in tasks.

NetCDF: versions 1, 2 and 5 (data of HDF5-based files isn't classic). The last two dimensions are latitude and longitude, one of
``LEADS`` is the lead time, all others are taken at their first place. GRIB2: regular latitude-longitude grids (template
3.0) in simple packing (5.0), constant fields and bitmaps included; other templates are in the index but raise when read.

Cases: missing values (``_FillValue``, ``missing_value``, NaN, bits off in a bitmap) are rows with a null value; a file that is
neither raises and names itself; an empty folder gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

#: Names of dimensions.
LEADS = ("forecast_period", "time", "step", "leadtime")
LATITUDES, LONGITUDES = ("latitude", "lat"), ("longitude", "lon")
#: Bytes of a file's head read at first; more are read until its header is whole.
HEAD = 1 << 16
_KINDS = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
_CELLS = "lat double, lng double, value double"


def listed_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, length`` of the files below a folder; their contents aren't read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path).select("path", "length")


class Variable(NamedTuple):
    dims: list[int]
    attributes: dict
    kind: str
    begin: int


class NetCdf:
    """A classic header: dimensions, variables and where their data lie."""

    def __init__(self, data: bytes):
        if data[:3] != b"CDF" or data[3] not in (1, 2, 5):
            raise ValueError("no NetCDF classic file")
        self.data, self.at, version = data, 4, data[3]
        self.wide, self.offset = (">q" if version == 5 else ">i"), (">i" if version == 1 else ">q")
        self.records = self._number(self.wide)
        self.dims = [(self._name(), self._number(self.wide)) for _ in range(self._list())]
        self._attributes()
        self.variables: dict[str, Variable] = {}
        for _ in range(self._list()):
            name, dims = self._name(), [self._number(self.wide) for _ in range(self._number(self.wide))]
            attributes, kind = self._attributes(), _KINDS[self._number(">i")]
            self._number(self.wide)  # the size, which large variables can't state
            self.variables[name] = Variable(dims, attributes, kind, self._number(self.offset))
        sizes = [self.step(v) for v in self.variables.values() if self.in_records(v)]
        # a lone record variable isn't padded
        self.record = sizes[0] if len(sizes) == 1 else sum(-(-s // 4) * 4 for s in sizes)

    def _take(self, n: int) -> bytes:
        if self.at + n > len(self.data):
            raise EOFError
        self.at += n
        return self.data[self.at - n : self.at]

    def _number(self, kind: str) -> int:
        return struct.unpack(kind, self._take(struct.calcsize(kind)))[0]

    def _padded(self, n: int) -> bytes:
        return self._take(-(-n // 4) * 4)[:n]

    def _name(self) -> str:
        return self._padded(self._number(self.wide)).decode()

    def _list(self) -> int:
        self._take(4)
        return self._number(self.wide)

    def _attributes(self) -> dict:
        out = {}
        for _ in range(self._list()):
            name, kind = self._name(), _KINDS[self._number(">i")]
            n = self._number(self.wide)
            raw = self._padded(n * np.dtype(kind).itemsize)
            out[name] = raw.decode("utf-8", "replace") if kind == "S1" else np.frombuffer(raw, kind).tolist()
        return out

    def in_records(self, v: Variable) -> bool:
        return bool(v.dims) and self.dims[v.dims[0]][1] == 0

    def step(self, v: Variable) -> int:
        """Bytes of a variable, or of its part in one record."""
        return int(np.prod([self.dims[d][1] for d in v.dims if self.dims[d][1]], dtype=np.int64)) * np.dtype(v.kind).itemsize

    def place(self, v: Variable, index: list[int]) -> int:
        """Where the value of an index begins."""
        at, scale = v.begin, np.dtype(v.kind).itemsize
        inner = list(zip(v.dims, index, strict=True))
        if self.in_records(v):
            at += index[0] * self.record
            inner = inner[1:]
        for d, i in reversed(inner):
            at += i * scale
            scale *= self.dims[d][1]
        return at


def read_range(store: fs.FileSystem, path: str, at: int, n: int) -> bytes:
    with store.open_input_file(path) as f:
        f.seek(at)
        return f.read(n)


def _header(store: fs.FileSystem, path: str, length: int) -> NetCdf:
    size = HEAD
    while True:
        try:
            made = NetCdf(read_range(store, path, 0, min(size, length)))
        except EOFError:
            if size >= length:
                raise
            size *= 4
            continue
        if made.records < 0:  # written as a stream: what the file holds
            begins = [v.begin for v in made.variables.values() if made.in_records(v)]
            made.records = (length - min(begins)) // made.record if begins else 0
        return made


def _line(store: fs.FileSystem, path: str, head: NetCdf, name: str) -> np.ndarray:
    """A coordinate's values."""
    v = head.variables[name]
    if not head.in_records(v):
        return np.frombuffer(read_range(store, path, v.begin, head.step(v)), v.kind).astype(float)
    return np.array([np.frombuffer(read_range(store, path, head.place(v, [i]), np.dtype(v.kind).itemsize), v.kind)[0] for i in range(head.records)], float)


def netcdf_slabs(files: DataFrame) -> DataFrame:
    """The index of ``files(path, length)``: a row for each variable over latitude and longitude and each lead time (0 where it has none)."""
    schema = "path string, variable string, place int, lead double, unit string, at long, kind string, scale double, shift double, missing array<double>, lats array<double>, lngs array<double>"
    kind = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                store, inner = fs.FileSystem.from_uri(path)
                try:
                    head = _header(store, inner, length)
                except (ValueError, EOFError) as e:
                    raise ValueError(f"{path}: {e or 'the header is cut off'}") from e
                rows = []
                for name, v in head.variables.items():
                    dims = [head.dims[d][0] for d in v.dims]
                    if len(dims) < 2 or dims[-2] not in LATITUDES or dims[-1] not in LONGITUDES:
                        continue
                    lats, lngs = (_line(store, inner, head, d).tolist() for d in dims[-2:])
                    lead = next((d for d in dims[:-2] if d in LEADS), None)
                    n = 1 if lead is None else head.dims[v.dims[dims.index(lead)]][1] or head.records
                    leads = _line(store, inner, head, lead) if lead in head.variables else np.arange(n, dtype=float)
                    unit = str(head.variables[lead].attributes.get("units", "")) if lead in head.variables else ""
                    one = lambda key, default, v=v: float(np.ravel(v.attributes.get(key, default))[0])
                    missing = [float(x) for key in ("_FillValue", "missing_value") for x in np.ravel(v.attributes.get(key, []))]
                    for place in range(n):
                        at = head.place(v, [place if d == lead else 0 for d in dims[:-2]] + [0, 0])
                        rows.append((path, name, place, float(leads[place]), unit, at, v.kind, one("scale_factor", 1.0), one("add_offset", 0.0), missing, lats, lngs))
                yield pa.RecordBatch.from_pylist([dict(zip(kind.names, r, strict=True)) for r in rows], schema=kind)

    return files.select("path", "length").mapInArrow(run, schema)


def _arrow(schema: str) -> pa.Schema:
    """The Arrow form of a flat schema."""
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))])


def _cells(kind: pa.Schema, lats: np.ndarray, lngs: np.ndarray, value: np.ndarray, **same) -> pa.RecordBatch:
    n = len(value)
    fixed = {k: pa.array([v], kind.field(k).type).take(pa.array(np.zeros(n, np.int32))) for k, v in same.items()}
    return pa.RecordBatch.from_pydict({**fixed, "lat": lats, "lng": lngs, "value": pa.array(value, pa.float64(), mask=~np.isfinite(value))})


def netcdf_cells(slabs: DataFrame) -> DataFrame:
    """``path, variable, lead, lat, lng, value`` of the slabs of an index, a task for each few of them."""
    schema = f"path string, variable string, lead double, {_CELLS}"
    made = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                store, inner = fs.FileSystem.from_uri(s["path"])
                lats, lngs, kind = np.array(s["lats"]), np.array(s["lngs"]), np.dtype(s["kind"])
                raw = np.frombuffer(read_range(store, inner, s["at"], len(lats) * len(lngs) * kind.itemsize), kind).astype(float)
                value = np.where(np.isin(raw, s["missing"]), np.nan, raw * s["scale"] + s["shift"])
                yield _cells(made, np.repeat(lats, len(lngs)), np.tile(lngs, len(lats)), value, path=s["path"], variable=s["variable"], lead=s["lead"])

    return slabs.repartition("path", "variable", "place").mapInArrow(run, schema)


def _signed(raw: bytes) -> int:
    """A sign bit and a size."""
    n = int.from_bytes(raw, "big")
    top = 1 << (8 * len(raw) - 1)
    return n if n < top else top - n


#: Hours of a unit of the forecast time (minute, hour, day, 3, 6 and 12 hours, second).
HOURS = {0: 1 / 60, 1: 1.0, 2: 24.0, 10: 3.0, 11: 6.0, 12: 12.0, 13: 1 / 3600}
_FIELDS = (
    "path string, message long, discipline int, category int, parameter int, surface int, level double, reference string, lead double, grid int, packing int, "
    "ni int, nj int, lat1 double, lng1 double, dlat double, dlng double, scan int, points int, base double, binary int, decimal int, bits int, bitmap long, at long, size long"
)


def _messages(store: fs.FileSystem, path: str, length: int) -> Iterator[dict]:
    """The fields of a file of messages, by the heads of their sections."""
    with store.open_input_file(path) as f:

        def at(place: int, n: int) -> bytes:
            f.seek(place)
            return f.read(n)

        start = 0
        while start < length:
            head = at(start, 16)
            if head[:4] != b"GRIB" or head[7] != 2:
                raise ValueError(f"no GRIB2 message at byte {start}")
            end, place, row = start + int.from_bytes(head[8:16], "big"), start + 16, {"message": start, "discipline": head[6]}
            while place < end - 4:
                section = at(place, 5)
                size, number = int.from_bytes(section[:4], "big"), section[4]
                if number not in (2, 6, 7):
                    section = at(place, size)
                if number == 1:
                    row["reference"] = "%04d-%02d-%02d %02d:%02d:%02d" % struct.unpack(">HBBBBB", section[12:19])
                elif number == 3:
                    row["grid"] = int.from_bytes(section[12:14], "big")
                    if row["grid"] == 0:
                        u = lambda k: int.from_bytes(section[k : k + 4], "big")
                        g = lambda k: _signed(section[k : k + 4]) / 1e6
                        row |= {"ni": u(30), "nj": u(34), "lat1": g(46), "lng1": g(50), "dlng": u(63) / 1e6, "dlat": u(67) / 1e6, "scan": section[71]}
                elif number == 4:
                    scale, value = _signed(section[23:24]), _signed(section[24:28])
                    row |= {"category": section[9], "parameter": section[10], "surface": section[22], "level": value / 10.0**scale, "lead": int.from_bytes(section[18:22], "big") * HOURS.get(section[17], float("nan"))}
                elif number == 5:
                    row |= {"points": int.from_bytes(section[5:9], "big"), "packing": int.from_bytes(section[9:11], "big")}
                    if row["packing"] == 0:
                        row |= {"base": struct.unpack(">f", section[11:15])[0], "binary": _signed(section[15:17]), "decimal": _signed(section[17:19]), "bits": section[19]}
                elif number == 6:
                    kind = at(place + 5, 1)[0]
                    if kind != 254:  # 254: the one before holds
                        row["bitmap"] = place + 6 if kind == 0 else None
                elif number == 7:
                    yield row | {"at": place + 5, "size": size - 5}
                place += size
            start = end


def grib_fields(files: DataFrame) -> DataFrame:
    """The index of ``files(path, length)``: a row a field, by parameter, level and lead time in hours."""
    schema = _arrow(_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                store, inner = fs.FileSystem.from_uri(path)
                try:
                    rows = [{"path": path} | r for r in _messages(store, inner, length)]
                except ValueError as e:
                    raise ValueError(f"{path}: {e}") from e
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.select("path", "length").mapInArrow(run, _FIELDS)


def unpacked(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first n unsigned numbers of so many bits each."""
    if not bits:
        return np.zeros(n, np.int64)
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", n).astype(np.int64)
    flags = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits).reshape(n, bits)
    out = np.zeros(n, np.int64)
    for k in range(bits):
        out = (out << 1) | flags[:, k]
    return out


def grib_cells(fields: DataFrame) -> DataFrame:
    """``path, message, discipline, category, parameter, level, lead, lat, lng, value`` of the fields of an index."""
    schema = f"path string, message long, discipline int, category int, parameter int, level double, lead double, {_CELLS}"
    made = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                if s["grid"] != 0 or s["packing"] != 0 or (s["scan"] & 0b00110000):
                    raise ValueError(f"{s['path']}, message at {s['message']}: grid template 3.{s['grid']}, packing 5.{s['packing']}, scanning {s['scan']} can't be read")
                store, inner = fs.FileSystem.from_uri(s["path"])
                n, cells = s["points"], s["ni"] * s["nj"]
                x = unpacked(read_range(store, inner, s["at"], s["size"]), s["bits"], n)
                value = (s["base"] + x * 2.0 ** s["binary"]) / 10.0 ** s["decimal"]
                if s["bitmap"] is not None:
                    there = np.unpackbits(np.frombuffer(read_range(store, inner, s["bitmap"], -(-cells // 8)), np.uint8), count=cells).astype(bool)
                    whole = np.full(cells, np.nan)
                    whole[there] = value[: int(there.sum())]
                    value = whole
                east, north = (-1 if s["scan"] & 0b10000000 else 1), (1 if s["scan"] & 0b01000000 else -1)
                lats = s["lat1"] + north * s["dlat"] * np.arange(s["nj"])
                lngs = s["lng1"] + east * s["dlng"] * np.arange(s["ni"])
                yield _cells(made, np.repeat(lats, s["ni"]), np.tile(lngs, s["nj"]), value, **{k: s[k] for k in ("path", "message", "discipline", "category", "parameter", "level", "lead")})

    return fields.repartition("path", "message", "at").mapInArrow(run, schema)
