"""Polygon shapefiles with their attributes, as zip archives ``files(path, content)``.

Cases: records without a shape have null polygons; deleted attribute rows count as rows, as shapes do; text is UTF-8, what isn't
becomes a replacement mark; other kinds of shapes raise and name themselves.
"""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

Ring = list[tuple[float, float]]
#: Kinds of shapes.
NOTHING, POLYGONS = 0, (5, 15, 25)


def _area2(ring: Ring) -> float:
    return sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1], strict=True))


def _inside(ring: Ring, x: float, y: float) -> bool:
    return sum((p[1] > y) != (q[1] > y) and x < (q[0] - p[0]) * (y - p[1]) / (q[1] - p[1]) + p[0] for p, q in zip(ring, ring[1:] + ring[:1], strict=True)) % 2 == 1


def _polygons(content: bytes) -> list[list[Ring]] | None:
    """Shells, which run with the clock, each with its holes; rings are open."""
    kind = struct.unpack_from("<i", content)[0]
    if kind == NOTHING:
        return None
    if kind not in POLYGONS:
        raise ValueError(f"shapes of kind {kind} can't be read")
    n_parts, n_points = struct.unpack_from("<ii", content, 36)
    starts = [*struct.unpack_from(f"<{n_parts}i", content, 44), n_points]
    flat = struct.unpack_from(f"<{2 * n_points}d", content, 44 + 4 * n_parts)
    rings = [[(flat[2 * i], flat[2 * i + 1]) for i in range(a, b)] for a, b in zip(starts, starts[1:], strict=False)]
    rings = [r[:-1] if r[0] == r[-1] else r for r in rings]
    shells = sorted(([r] for r in rings if _area2(r) < 0), key=lambda s: -_area2(s[0]))
    for hole in (r for r in rings if _area2(r) > 0):
        # a hole may touch its shell, so a place between two of its points is asked for
        x, y = (hole[0][0] + hole[1][0]) / 2, (hole[0][1] + hole[1][1]) / 2
        home = next((s for s in shells if _inside(s[0], x, y)), None)
        if home is None:  # a shell that runs the wrong way
            shells.append([hole])
        else:
            home.append(hole)
    return shells


def shapes(data: bytes) -> Iterator[list[list[Ring]] | None]:
    at = 100
    while at + 8 <= len(data):
        size = struct.unpack_from(">i", data, at + 4)[0] * 2
        yield _polygons(data[at + 8 : at + 8 + size])
        at += 8 + size


def attributes(data: bytes) -> Iterator[dict[str, str]]:
    n, head, width = struct.unpack_from("<iHH", data, 4)
    fields, at = [], 32
    while data[at] != 0x0D:
        fields.append((data[at : at + 11].split(b"\0")[0].decode("utf-8", "replace"), data[at + 16]))
        at += 32
    for i in range(n):
        at, row = head + i * width + 1, {}
        for name, size in fields:
            row[name] = data[at : at + size].decode("utf-8", "replace").strip()
            at += size
        yield row


def shapefile_rows(files: DataFrame) -> DataFrame:
    """``path, record, fields map<string, string>, polygons`` with x and y as they are in the file; an archive at a time is in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        point = pa.struct([("x", pa.float64()), ("y", pa.float64())])
        kind = pa.schema([("path", pa.string()), ("record", pa.int32()), ("fields", pa.map_(pa.string(), pa.string())), ("polygons", pa.list_(pa.list_(pa.list_(point))))])
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                    named = {n.lower().rsplit(".", 1)[-1]: n for n in z.namelist()}
                    shp, dbf = z.read(named["shp"]), z.read(named["dbf"])
                rows = []
                for i, (shape, fields) in enumerate(zip(shapes(shp), attributes(dbf), strict=True)):
                    made = None if shape is None else [[[{"x": x, "y": y} for x, y in ring] for ring in rings] for rings in shape]
                    rows.append({"path": path, "record": i, "fields": list(fields.items()), "polygons": made})
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_pylist(rows, schema=kind)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=kind)

    return files.select("path", "content").mapInArrow(run, "path string, record int, fields map<string, string>, polygons array<array<array<struct<x: double, y: double>>>>")


def shapefile_bytes(rows: list[tuple[dict[str, str], list[list[Ring]] | None]]) -> bytes:
    """A zip archive of a polygon shapefile; a shell is turned to run with the clock, its holes against it."""
    records, names = [], list(rows[0][0]) if rows else []
    for i, (_, shape) in enumerate(rows, 1):
        rings = [r[::-1] if (_area2(r) > 0) == (k == 0) else r for rings in shape or [] for k, r in enumerate(rings)]
        closed = [p for r in rings for p in [*r, r[0]]]
        if shape is None:
            body = struct.pack("<i", NOTHING)
        else:
            xs, ys, starts = [p[0] for p in closed], [p[1] for p in closed], [sum(len(r) + 1 for r in rings[:k]) for k in range(len(rings))]
            body = struct.pack("<i4d2i", 5, min(xs), min(ys), max(xs), max(ys), len(rings), len(closed)) + struct.pack(f"<{len(starts)}i", *starts) + struct.pack(f"<{2 * len(closed)}d", *[c for p in closed for c in p])
        records.append(struct.pack(">ii", i, len(body) // 2) + body)
    data = b"".join(records)
    head = struct.pack(">i", 9994) + b"\0" * 20 + struct.pack(">i", (100 + len(data)) // 2) + struct.pack("<ii8d", 1000, 5, *[0.0] * 8)
    sizes = [max([1, *(len(f[n].encode()) for f, _ in rows)]) for n in names]
    described = b"".join(n.encode()[:10].ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([s, 0]) + b"\0" * 14 for n, s in zip(names, sizes, strict=True))
    table = bytes([3, 124, 1, 1]) + struct.pack("<iHH", len(rows), 33 + len(described), 1 + sum(sizes)) + b"\0" * 20 + described + b"\r"
    table += b"".join(b" " + b"".join(f[n].encode().ljust(s) for n, s in zip(names, sizes, strict=True)) for f, _ in rows)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("areas.shp", head + data)
        z.writestr("areas.dbf", table)
    return out.getvalue()
