"""Operator 3: linked metadata and plain-text conversion records from WARC responses.

A response record yields a metadata record (a JSON envelope with the source's
own headers, the HTTP message and the page's title, metas and links) and a conversion record
(its plain text). Both name the response in WARC-Refers-To, with its target and date, and
carry digests of their blocks; the source's digests are checked and kept.
Record ids are derived from the source's id, so a retried task makes the same records.

The work is per record: nothing is shuffled or gathered. Records can be read from and
written to gzipped WARC files, one member a record, through any store pyarrow knows.

A repeated header of the source, such as Set-Cookie, keeps all its values. Rows of one page id and address have one record id
only if their bodies are equal too.

Cases: null, empty and malformed records and digests that do not match or are of an unknown kind are reported in ``problem``; the
first three yield no derivatives, the others both; records of other types are
passed over; a response without a record id is malformed; bodies in an unknown encoding are converted as they
are; repeated records yield equal derivatives each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwharf.llm.common import staged

VERSION, EOL = b"WARC/1.1", b"\r\n"
Headers = list[tuple[str, str]]

_HIDING = re.compile(r"<(script|style|noscript|template)\b[^>]*>", re.I)
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template")}
_TAG = re.compile(r"""<(/?)([a-zA-Z][\w:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*+)>|<[!?][^>]*>""")
_ATTRIBUTE = re.compile(r"""([\w:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_BREAKS = frozenset("address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol option p pre section table td th title tr ul".split())
_LINKS = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "form": "action"}
_TITLE, _TITLE_END = re.compile(r"<title\b[^>]*>", re.I), re.compile(r"</title\s*>", re.I)
_CHARSET = re.compile(rb"""charset\s*=\s*["']?([\w-]+)""", re.I)


def without_hidden(page: str, keep_tags: bool = False) -> str:
    """A page with a space for each comment, script, style and the like (with ``keep_tags``: its first tag), in one pass forward; what never ends goes to the page's end."""
    out, at, last = [], 0, page.rfind(">") + 1
    tag, comment = _HIDING.search(page, 0, last), page.find("<!--")
    while tag or comment >= 0:
        if comment >= 0 and (tag is None or comment < tag.start()):
            start, end, left = comment, page.find("-->", comment + 4), " "
            end = len(page) if end < 0 else end + 3
        else:
            closed = _ENDS[tag[1].lower()].search(page, tag.end())
            start, end, left = tag.start(), closed.end() if closed else len(page), tag[0] if keep_tags else " "
        out += [page[at:start], left]
        at = end
        if tag and tag.start() < at:
            tag = _HIDING.search(page, at, max(at, last))
        if 0 <= comment < at:
            comment = page.find("<!--", at)
    return "".join([*out, page[at:]])


def title_of(page: str) -> str | None:
    """What stands in the first title, if it ends."""
    begun = _TITLE.search(page, 0, page.rfind(">") + 1)
    ended = _TITLE_END.search(page, begun.end()) if begun else None
    return page[begun.end() : ended.start()] if ended else None


def sha1(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block, usedforsecurity=False).digest()).decode()


# Digests that can be checked; their values are written in base 32 or base 16.
_DIGESTS = ("sha1", "md5", "sha256", "sha512")


def matches(told: str, blocks: list[bytes]) -> bool:
    """Whether a labelled digest is that of one of the blocks."""
    kind, _, value = told.partition(":")
    if kind.lower() not in _DIGESTS:
        return False
    raw = [hashlib.new(kind.lower(), b, usedforsecurity=False).digest() for b in blocks]
    return value.upper().rstrip("=") in {base64.b32encode(d).decode().rstrip("=") for d in raw} | {d.hex().upper() for d in raw}


def listed(headers: Headers) -> dict:
    """Headers by name in order of appearance; a name that is repeated has the list of its values."""
    out: dict = {}
    for k, v in headers:
        out[k] = v if k not in out else [*(out[k] if isinstance(out[k], list) else [out[k]]), v]
    return out


def make_record(kind: str, record_id: str, headers: Headers, block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", record_id), *headers, ("WARC-Block-Digest", sha1(block)), ("Content-Length", str(len(block)))]
    return VERSION + EOL + b"".join(f"{k}: {v}\r\n".encode() for k, v in lines) + EOL + block + EOL + EOL


def response_record(url: str, html_text: str, name: str, date: str = "2024-01-01T00:00:00Z") -> bytes:
    """A response record around an HTML page; its id is derived from ``name``."""
    body = html_text.encode("utf-8", "surrogatepass")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    target = re.sub(r"[\r\n]", "", url)
    headers = [("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", sha1(body)), ("Content-Type", "application/http; msgtype=response")]
    return make_record("response", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", headers, block)


def parse_headers(head: bytes) -> tuple[str, Headers]:
    """First line and fields of a header block; folded lines are joined."""
    lines = re.sub(rb"\r?\n[ \t]+", b" ", head).decode("utf-8", "replace").splitlines()
    return (lines[0] if lines else ""), [(k.strip(), v.strip()) for k, sep, v in (x.partition(":") for x in lines[1:]) if sep]


def field(headers: Headers, name: str) -> str | None:
    return next((v for k, v in headers if k.lower() == name.lower()), None)


def parse_record(record: bytes) -> tuple[Headers, bytes]:
    """Headers and block of one record; ValueError if it isn't one."""
    head, sep, rest = record.partition(b"\r\n\r\n")
    first, headers = parse_headers(head)
    length = field(headers, "Content-Length")
    if not first.startswith("WARC/") or not sep:
        raise ValueError("no WARC record")
    if length is None or not length.isdigit() or int(length) > len(rest):
        raise ValueError("the block is shorter than its Content-Length")
    if not field(headers, "WARC-Record-ID"):
        raise ValueError("no record id")
    return headers, rest[: int(length)]


def parse_http(block: bytes) -> tuple[str, Headers, bytes]:
    """Status line, headers and body, with transfer and content codings undone."""
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        head, _, body = block.partition(b"\n\n")
    status, headers = parse_headers(head)
    raw = body
    if "chunked" in (field(headers, "Transfer-Encoding") or "").lower():
        out, at = [], 0
        while (end := raw.find(b"\n", at)) >= 0:
            try:
                size = int(raw[at:end].split(b";")[0].strip() or b"0", 16)
            except ValueError:
                return status, headers, body
            if not size:
                break
            out.append(raw[end + 1 : end + 1 + size])
            at = end + 1 + size + (2 if raw[end + 1 + size : end + 3 + size] == b"\r\n" else 1)
        raw = b"".join(out)
    coding = (field(headers, "Content-Encoding") or "").lower()
    try:
        if coding in ("gzip", "x-gzip"):
            raw = gzip.decompress(raw)
        elif coding == "deflate":
            raw = zlib.decompress(raw)
    except (OSError, EOFError, zlib.error):
        pass
    return status, headers, raw


def body_text(headers: Headers, body: bytes) -> str:
    found = _CHARSET.search((field(headers, "Content-Type") or "").encode()) or _CHARSET.search(body[:4096])
    try:
        return body.decode(found[1].decode() if found else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def plain_text(page: str) -> str:
    """Visible text, a line for each block element, white space collapsed, empty lines left out."""
    marked = _TAG.sub(lambda m: "\n" if (m[2] or "").lower() in _BREAKS else " " if m[2] is None else "", without_hidden(page).replace("\n", " "))
    lines = (" ".join(x.split()) for x in html.unescape(marked).split("\n"))
    return "\n".join(x for x in lines if x)


def page_facts(page: str) -> dict:
    """Title, metas and links in order of appearance."""
    seen = without_hidden(page, keep_tags=True)
    title, metas, links = title_of(seen), [], []
    for m in _TAG.finditer(seen):
        tag = (m[2] or "").lower()
        if m[1] or (tag != "meta" and tag not in _LINKS):
            continue
        attributes = {a[1].lower(): html.unescape(a[2] or a[3] or a[4] or "") for a in _ATTRIBUTE.finditer(m[3])}
        if tag == "meta":
            metas.append(attributes)
        elif attributes.get(_LINKS[tag]):
            links.append({"path": f"{tag.upper()}@/{_LINKS[tag]}", "url": attributes[_LINKS[tag]]})
    return {"Head": {"Title": html.unescape(" ".join(title.split())) if title is not None else None, "Metas": metas}, "Links": links}


def derive(record: bytes | None) -> tuple[str | None, list[dict]]:
    """``(problem, derivatives)`` of one record."""
    try:
        headers, block = parse_record(record or b"")
    except ValueError as e:
        return str(e), []
    if (field(headers, "WARC-Type") or "").lower() != "response":
        return None, []
    status, http, body = parse_http(block)
    page = body_text(http, body)
    text = plain_text(page).encode("utf-8", "replace")
    raw_body = block.partition(b"\r\n\r\n")[2]
    problem = None
    for name, data in (("WARC-Block-Digest", [block]), ("WARC-Payload-Digest", [raw_body, body])):
        told = field(headers, name)
        if told and not matches(told, data):
            problem = f"{name} does not match" if told.partition(":")[0].lower() in _DIGESTS else f"{name} is of an unknown kind"
    source = field(headers, "WARC-Record-ID")
    shared = [("WARC-Refers-To", source)]
    shared += [(f"WARC-Refers-To-{k.removeprefix('WARC-')}", field(headers, k)) for k in ("WARC-Target-URI", "WARC-Date") if field(headers, k)]
    shared += [(k, field(headers, k)) for k in ("WARC-Date", "WARC-Target-URI") if field(headers, k)]
    envelope = {
        "Envelope": {
            "Format": "WARC",
            "WARC-Header-Metadata": listed(headers),
            "Payload-Metadata": {
                "Actual-Content-Type": "application/http; msgtype=response",
                "HTTP-Response-Metadata": {"Response-Message": status, "Headers": listed(http), "Entity-Length": len(body), "Entity-Digest": sha1(body), "HTML-Metadata": page_facts(page)},
            },
        }
    }
    metadata = json.dumps(envelope, ensure_ascii=False, separators=(",", ":")).encode("utf-8", "replace")
    out = []
    for kind, content, data in (("metadata", "application/json", metadata), ("conversion", "text/plain; charset=utf-8", text)):
        record_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source}#{kind}')}>"
        out.append(
            {
                "warc_type": kind, "record_id": record_id, "refers_to": source, "target_uri": field(headers, "WARC-Target-URI"), "source_date": field(headers, "WARC-Date"),
                "source_block_digest": field(headers, "WARC-Block-Digest"), "source_payload_digest": field(headers, "WARC-Payload-Digest"), "block_digest": sha1(data),
                "record": make_record(kind, record_id, [*shared, ("Content-Type", content)], data),
            }
        )
    return problem, out


KINDS = "key long, problem string, warc_type string, record_id string, refers_to string, target_uri string, source_date string, source_block_digest string, source_payload_digest string, block_digest string, record binary"
_SCHEMA = pa.schema([(x.split()[0], {"long": pa.int64(), "binary": pa.binary()}.get(x.split()[1], pa.string())) for x in KINDS.split(", ")])


def build_derivatives(responses: DataFrame, key_col: str = "key", record_col: str = "record") -> DataFrame:
    """Two rows for each response, one (without a record) for each record with nothing to derive but a problem."""
    schema = _SCHEMA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, record in zip(batch.column("key").to_pylist(), batch.column("record"), strict=True):
                problem, made = derive(record.as_py())
                rows += [{"key": key, "problem": problem, **m} for m in made or ([{}] if problem else [])]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return responses.select(F.col(key_col).cast("long").alias("key"), F.col(record_col).alias("record")).mapInArrow(run, KINDS)


def write_warcs(records: DataFrame, folder: str, record_col: str = "record") -> DataFrame:
    """Write the records to gzipped WARC files below ``folder``; returns the staged manifest ``part, file, n_records``.

    Only files named by the manifest count; those of failed attempts are orphans.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        file, n = f"{root}/part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz", 0
        with store.open_output_stream(file, compression=None) as out:
            for batch in batches:
                for record in batch.column(0):
                    if record.is_valid:
                        out.write(gzip.compress(record.as_py(), 6, mtime=0))
                        n += 1
        yield pa.RecordBatch.from_pydict({"part": pa.array([context.partitionId()], pa.int32()), "file": [file], "n_records": pa.array([n], pa.int64())})

    return staged(records.select(record_col).mapInArrow(run, "part int, file string, n_records long"), "warc_files")


def split_records(src: io.BufferedIOBase) -> Iterator[bytes]:
    """The records of an uncompressed WARC stream, one in memory at a time."""
    while True:
        first = src.readline()
        if not first:
            return
        if not first.strip():
            continue
        head = [first]
        while (line := src.readline()).strip():
            head.append(line)
        _, headers = parse_headers(b"".join(head))
        length = field(headers, "Content-Length") or "0"
        yield b"".join(head) + EOL + src.read(int(length) if length.isdigit() else 0) + EOL + EOL


def read_warcs(spark: SparkSession, files: DataFrame, folder: str, key_from: int = 0) -> DataFrame:
    """``key, record`` of the files named by ``files(file)``; ``key`` counts the records of a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file in batch.column("file").to_pylist():
                with store.open_input_stream(file, compression=None) as raw, gzip.GzipFile(fileobj=raw) as unzipped:
                    held = []
                    for n, record in enumerate(split_records(io.BufferedReader(unzipped)), key_from):
                        held.append((n, record))
                        if len(held) == 256:
                            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in held], pa.int64()), pa.array([r for _, r in held], pa.binary())], ["key", "record"])
                            held = []
                    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in held], pa.int64()), pa.array([r for _, r in held], pa.binary())], ["key", "record"])

    # a row stands for a whole file, so adaptive execution must not merge these small partitions: the number is fixed
    return files.select("file").repartitionByRange(max(1, files.count()), "file").mapInArrow(run, "key long, record binary")


def page_responses(pages: DataFrame) -> DataFrame:
    """``key, record``: a response record around each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True)
            records = [response_record(url or "about:blank", page or "", f"{key}|{url}|{sha1((page or '').encode('utf-8', 'surrogatepass'))}") for key, url, page in rows]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(records, pa.binary())], ["key", "record"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "key long, record binary")


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    made = build_derivatives(page_responses(pages))
    return made.withColumnRenamed("key", "page_id").withColumn("record", F.decode("record", "UTF-8"))
