import hashlib
import gzip
import json
from html.parser import HTMLParser

import pytest
from pyspark.sql import types as T

from sparkwharf.llm import warc as m
from sparkwharf.llm.common import staging_path

PAGE = """<!DOCTYPE html><html><head><title>A &amp; B
 title</title><meta charset="utf-8"><meta name='x' content=y><script src="a.js">var t="</p>";</script><style>p{}</style></head>
<body><!-- no <b>comment</b> --><nav><a href="/one?a=1&amp;b=2">One</a></nav><p>First <b>bold</b>text<br>second&nbsp;line<p title="a > b">1 < 2 &copy;</body></html>"""


def test_response_round_trip_and_derivatives():
    record = m.response_record("http://x.example/é", PAGE, "name")
    headers, block = m.parse_record(record)
    assert m.make_record("response", m.field(headers, "WARC-Record-ID"), headers[2:-2], block) == record
    problem, (meta, text) = m.derive(record)
    assert problem is None
    for made in (meta, text):
        h, b = m.parse_record(made["record"])
        assert m.field(h, "WARC-Refers-To") == m.field(headers, "WARC-Record-ID") == made["refers_to"]
        assert m.field(h, "WARC-Block-Digest") == m.sha1(b) == made["block_digest"]
        assert made["source_payload_digest"] == m.sha1(PAGE.encode()) and m.field(h, "WARC-Refers-To-Target-URI") == "http://x.example/é"
    assert m.parse_record(text["record"])[1].decode() == "A & B title\nOne\nFirst boldtext\nsecond line\n1 < 2 ©"
    envelope = json.loads(m.parse_record(meta["record"])[1])["Envelope"]
    assert envelope["WARC-Header-Metadata"] == m.listed(headers)
    facts = envelope["Payload-Metadata"]["HTTP-Response-Metadata"]["HTML-Metadata"]
    assert facts["Head"]["Title"] == "A & B title" and facts["Head"]["Metas"] == [{"charset": "utf-8"}, {"name": "x", "content": "y"}]
    assert facts["Links"] == [{"path": "SCRIPT@/src", "url": "a.js"}, {"path": "A@/href", "url": "/one?a=1&b=2"}]
    assert m.derive(record) == m.derive(record) and meta["record_id"] != text["record_id"]


class Words(HTMLParser):
    """The words of a page by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.off, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style")
        if tag in m._BREAKS:
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style")
        if tag in m._BREAKS:
            self.out.append(" ")

    def handle_data(self, data):
        if not self.off:
            self.out.append(data)


def test_text_of_whole_pages_against_a_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    for r in pages:
        parser = Words()
        parser.feed(r.html)
        parser.close()
        assert m.plain_text(r.html).split() == "".join(parser.out).split()


def http(headers, body):
    return b"HTTP/1.1 200 OK\r\n" + headers + b"\r\n\r\n" + body


@pytest.mark.parametrize("block, text", [
    (http(b"Content-Encoding: gzip", gzip.compress(b"<p>zipped")), "zipped"),
    (http(b"Content-Encoding: gzip", b"not gzip"), "not gzip"),
    (http(b"Transfer-Encoding: chunked", b"5\r\n<p>on\r\n3;x\r\nce!\r\n0\r\n\r\n"), "once!"),
    (http(b"Content-Type: text/html; charset=latin-1", "é".encode("latin-1")), "é"),
    (http(b"Content-Type: text/html; charset=nonsense", "é".encode()), "é"),
    (http(b"X: y", b""), ""),
    (b"", ""),
])
def test_http_bodies(block, text):
    record = m.make_record("response", "<urn:x>", [("WARC-Date", "d")], block)
    problem, made = m.derive(record)
    assert problem is None and m.parse_record(made[1]["record"])[1].decode() == text


def test_problems():
    good = m.response_record("u", "<p>x", "n")
    assert m.derive(None)[0] and m.derive(b"")[0] and m.derive(b"junk")[0] and m.derive(good[:200])[0]
    assert m.derive(m.make_record("warcinfo", "<urn:y>", [], b"")) == (None, [])
    problem, made = m.derive(good.replace(b"<p>x", b"<p>y"))
    assert "does not match" in problem and len(made) == 2
    assert m.derive(m.make_record("response", "", [], b""))[0] == "no record id"


def test_tables_and_files(spark):
    schema = T.StructType([T.StructField(n, t) for n, t in (("page_id", T.LongType()), ("url", T.StringType()), ("html", T.StringType()), ("record", T.StringType()), ("key", T.StringType()))])
    rows = [(1, "http://a", PAGE, "clash", "clash"), (1, "http://a", PAGE, "clash", "clash"), (None, None, None, None, None), (2, "http://b", "", None, None), (3, "http://c", "<p>long " * 40000, None, None)]
    responses = m.page_responses(spark.createDataFrame(rows, schema))
    made = m.build_derivatives(responses).collect()
    assert len(made) == 10 and all(r.problem is None for r in made)
    folder = staging_path(spark, "test_warc")
    files = m.write_warcs(responses, folder)
    back = m.read_warcs(spark, files, folder)
    assert sorted(bytes(r.record) for r in back.collect()) == sorted(bytes(r.record) for r in responses.collect())
    empty = spark.createDataFrame([], schema)
    assert m.build_derivatives(m.page_responses(empty)).collect() == []


def test_repeated_headers_and_other_digests_are_kept():
    block = http(b"Set-Cookie: a=1\r\nSet-Cookie: b=2", b"<p>x")
    make = lambda digest: m.make_record("response", "<urn:x>", [("WARC-Concurrent-To", "<urn:y>"), ("WARC-Concurrent-To", "<urn:z>"), ("WARC-Payload-Digest", digest)], block)
    good = hashlib.sha256(b"<p>x").hexdigest()
    for digest, problem in ((f"sha256:{good}", None), ("sha256:00", "WARC-Payload-Digest does not match"), ("crc:1", "WARC-Payload-Digest is of an unknown kind")):
        told, made = m.derive(make(digest))
        assert told == problem and len(made) == 2
    envelope = json.loads(m.parse_record(made[0]["record"])[1])["Envelope"]
    assert envelope["WARC-Header-Metadata"]["WARC-Concurrent-To"] == ["<urn:y>", "<urn:z>"]
    assert envelope["Payload-Metadata"]["HTTP-Response-Metadata"]["Headers"]["Set-Cookie"] == ["a=1", "b=2"]


def test_query_over_a_folder(spark, tmp_path):
    rows = [(1, "http://a", PAGE), (1, "http://a", PAGE), (1, "http://a", "<p>other"), (None, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = m.op3_warc_derivatives(spark, str(tmp_path)).collect()
    assert len(got) == 8 and all(r.problem is None for r in got)
    assert len({r.record_id for r in got}) == 6
    want = [m.derive(m.response_record(u or "about:blank", h or "", f"{i}|{u}|{m.sha1((h or '').encode())}"))[1] for i, u, h in rows]
    strip = lambda r: r.decode().split("WARC-Date")[0]
    assert sorted(r.record_id for r in got) == sorted(x["record_id"] for d in want for x in d)
    assert sorted(r.record.split("WARC-Date")[0] for r in got) == sorted(strip(x["record"]) for d in want for x in d)


def test_hidden_parts_and_titles_as_by_plain_patterns():
    """The forward pass against backtracking patterns that say the same, on pages full of loose ends."""
    import random
    import re

    hidden = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
    title = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
    rng = random.Random(4)
    bits = ["<script>", "<SCRIPT src='x'>", "</script>", "</Script >", "<script", "<style>", "</style>", "<!--", "-->", "<!-->", "<title>", "<title lang=en>", "</title>", "</title\n>", "<title", "x", " ", ">", "<templates>", "<template>"]
    for _ in range(4000):
        page = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        assert m.without_hidden(page) == hidden.sub(" ", page)
        assert m.without_hidden(page, True) == hidden.sub(lambda x: x[0][: x[0].index(">") + 1] if x[1] and ">" in x[0] else " ", page)
        found = title.search(page)
        assert m.title_of(page) == (found[1] if found else None)


@pytest.mark.parametrize("part", ["<title>", "<script ", "<!--", "<script>", "<style></style><!-- -->", "<title", "a<b "])
def test_hostile_megabytes(part):
    import time

    began = time.perf_counter()
    page = part * (1_000_000 // len(part))
    m.page_facts(page)
    m.plain_text(page)
    assert time.perf_counter() - began < 10
