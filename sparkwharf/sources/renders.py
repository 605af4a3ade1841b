"""Files written from rows in tasks, in the formats that the readers of this folder take: for exports and round trips."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame


def write_files(rows: DataFrame, folder: str, name: Callable[[dict], str], content: Callable[[dict], bytes]) -> DataFrame:
    """A file for each row below a shared folder; ``path, length`` of those that the committed attempts wrote."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        store, root = fs.FileSystem.from_uri(folder)
        scheme = folder[: folder.index(root)] if root in folder else ""
        store.create_dir(f"{root}/{attempt}", recursive=True)
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                data = content(row)
                with store.open_output_stream(f"{root}/{attempt}/{name(row)}") as out:
                    out.write(data)
                made.append((f"{scheme}{root}/{attempt}/{name(row)}", len(data)))
            yield pa.RecordBatch.from_pydict({"path": [p for p, _ in made], "length": pa.array([n for _, n in made], pa.int64())})

    manifest = f"{folder}/_manifest"
    rows.mapInArrow(run, "path string, length long").write.parquet(manifest)
    return rows.sparkSession.read.schema("path string, length long").parquet(manifest)


def netcdf_bytes(dims: list[tuple[str, int | None]], variables: dict[str, tuple[list[str], np.ndarray, dict]], version: int = 1) -> bytes:
    """A NetCDF classic file; a dimension of length None grows with the records, and variables have (dimensions, values, attributes)."""
    wide, offset = (">q" if version == 5 else ">i"), (">i" if version == 1 else ">q")
    kinds = {"i1": 1, "S1": 2, "i2": 3, "i4": 4, "f4": 5, "f8": 6, "u1": 7, "u2": 8, "u4": 9, "i8": 10, "u8": 11}
    number = lambda n: struct.pack(wide, n)
    padded = lambda b: b + b"\0" * (-len(b) % 4)
    named = lambda s: number(len(s.encode())) + padded(s.encode())
    listed = lambda tag, parts: struct.pack(">i", tag if parts else 0) + number(len(parts)) + b"".join(parts)

    def attribute(key: str, value) -> bytes:
        if isinstance(value, str):
            return named(key) + struct.pack(">i", 2) + number(len(value.encode())) + padded(value.encode())
        value = np.atleast_1d(value)
        return named(key) + struct.pack(">i", kinds[value.dtype.str[1:]]) + number(value.size) + padded(value.astype(value.dtype.newbyteorder(">")).tobytes())

    order, grows = [d for d, _ in dims], {d for d, n in dims if n is None}
    records = next((len(v) for ds, v, _ in variables.values() if ds and ds[0] in grows), 0)
    big = {k: np.ascontiguousarray(v.astype(v.dtype.newbyteorder(">"))) for k, (_, v, _) in variables.items()}
    parts = {k: (big[k].nbytes // max(records, 1) if variables[k][0] and variables[k][0][0] in grows else big[k].nbytes) for k in variables}

    def head(begins: dict[str, int]) -> bytes:
        made = [
            named(k) + number(len(ds)) + b"".join(number(order.index(d)) for d in ds) + listed(12, [attribute(a, x) for a, x in attributes.items()])
            + struct.pack(">i", kinds[v.dtype.str[1:]]) + number(-(-parts[k] // 4) * 4) + struct.pack(offset, begins[k])
            for k, (ds, v, attributes) in variables.items()
        ]
        return b"CDF" + bytes([version]) + number(records) + listed(10, [named(d) + number(n or 0) for d, n in dims]) + listed(12, []) + listed(11, made)

    fixed = [k for k, (ds, _, _) in variables.items() if not (ds and ds[0] in grows)]
    moving = [k for k in variables if k not in fixed]
    at, begins = len(head(dict.fromkeys(variables, 0))), {}
    for k in fixed:
        begins[k], at = at, at + -(-parts[k] // 4) * 4
    for k in moving:
        begins[k], at = at, at + (-(-parts[k] // 4) * 4 if len(moving) > 1 else parts[k])
    body = b"".join(padded(big[k].tobytes()) for k in fixed)
    body += b"".join(padded(big[k][r : r + 1].tobytes()) if len(moving) > 1 else big[k][r : r + 1].tobytes() for r in range(records) for k in moving)
    return head(begins) + body


def _sign_and_size(n: int, size: int) -> bytes:
    return (abs(n) | (1 << (8 * size - 1) if n < 0 else 0)).to_bytes(size, "big")


def packed(numbers: np.ndarray, bits: int) -> bytes:
    flags = (numbers.astype(np.uint64)[:, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(flags.astype(np.uint8).ravel()).tobytes()


def grib_bytes(value: np.ndarray, lats: tuple[float, float], lngs: tuple[float, float], category: int, parameter: int, level: float, lead_hours: int, reference: tuple = (2024, 1, 1, 0, 0, 0), bits: int = 16, decimal: int = 0, discipline: int = 0) -> bytes:
    """A GRIB2 message of one field, rows from the first latitude on, each from the first longitude; NaN goes into a bitmap.

    ``lats`` and ``lngs`` are (first, step); values are whole numbers of ``10**-decimal`` after packing.
    """
    section = lambda number, body: (len(body) + 5).to_bytes(4, "big") + bytes([number]) + body
    nj, ni = value.shape
    there, micro = np.isfinite(value), lambda d: _sign_and_size(round(d * 1e6), 4)
    whole = np.round(value[there] * 10.0**decimal).astype(np.int64)
    low = np.float32(whole.min() if whole.size else 0)  # the format holds it in 32 bits
    low = int(np.nextafter(low, np.float32(-np.inf)) if whole.size and low > whole.min() else low)
    bits = 0 if not whole.size or (whole == low).all() else bits
    if bits and int(whole.max()) - low >= 1 << bits:
        raise ValueError(f"the field needs more than {bits} bits")
    scan = 0x40 if lats[1] > 0 else 0
    last = (lats[0] + (nj - 1) * lats[1], lngs[0] + (ni - 1) * lngs[1])
    year, *clock = reference
    body = section(1, struct.pack(">HHBBB", 7, 0, 2, 1, 1) + struct.pack(">H5B", year, *clock) + bytes([0, 1]))
    grid = bytes([0]) + struct.pack(">I", ni * nj) + bytes([0, 0]) + struct.pack(">H", 0) + bytes([6]) + b"\xff" * 15 + struct.pack(">II", ni, nj) + struct.pack(">II", 0, 0xFFFFFFFF)
    body += section(3, grid + micro(lats[0]) + micro(lngs[0]) + bytes([48]) + micro(last[0]) + micro(last[1]) + struct.pack(">II", round(lngs[1] * 1e6), round(abs(lats[1]) * 1e6)) + bytes([scan]))
    places = 0 if float(level).is_integer() else 2
    body += section(4, struct.pack(">HH", 0, 0) + bytes([category, parameter, 2, 0, 0]) + struct.pack(">HBBI", 0, 0, 1, lead_hours) + bytes([103]) + _sign_and_size(places, 1) + _sign_and_size(round(level * 10**places), 4) + b"\xff" * 6)
    body += section(5, struct.pack(">IH", whole.size, 0) + struct.pack(">f", low) + _sign_and_size(0, 2) + _sign_and_size(decimal, 2) + bytes([bits, 0]))
    body += section(6, bytes([255]) if there.all() else bytes([0]) + np.packbits(there.ravel().astype(np.uint8)).tobytes())
    body += section(7, packed(whole - low, bits) if bits else b"") + b"7777"
    return b"GRIB" + b"\0\0" + bytes([discipline, 2]) + (16 + len(body)).to_bytes(8, "big") + body
