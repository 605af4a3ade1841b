"""Python data sources over pages: some pages an input partition, errors kept apart as rows, a row a page; in batch and as a polled stream.

``fetch`` is named by module and function, so that tests and deployments bring their own transport; it is called as
``fetch(key, offset, size)`` with the source's other options by name, and gives a page's rows as dictionaries.

As a stream, an offset is the number of rows of each key that have been taken. Spark logs it before a batch runs, so a batch
that fails is asked for again with the same pages, and nothing is skipped or taken twice. ``upto`` names a function that tells
how many rows a key has by now, and ``limit`` bounds the pages of one batch.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterator

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

_OWN = {"keys", "pagesize", "total", "fetch", "upto", "limit"}


#: About how many input partitions a read has at most; smaller ones have one for each page.
PARTITIONS = 200


class Pages(InputPartition):
    """The pages of ``size`` rows of a key from ``offset`` on."""

    def __init__(self, key: str, offset: int, size: int):
        super().__init__(offset)
        self.key, self.offset, self.size = key, offset, size


def _named(path: str) -> Callable:
    module, _, name = path.rpartition(".")
    return getattr(importlib.import_module(module), name)  # a missing function is the job's fault, not a page's


class _Pages:
    def __init__(self, options: dict):
        self.options = dict(options)
        self.keys, self.size = json.loads(options.get("keys", '[""]')), int(options.get("pagesize", 1000))
        self.more = {k: v for k, v in self.options.items() if k not in _OWN}

    def dealt(self, spans: dict[str, tuple[int, int]]) -> list[Pages]:
        """The pages of each key's rows, in partitions."""
        pages = sum(-(-(end - at) // self.size) for at, end in spans.values())
        step = self.size * max(1, -(-pages // PARTITIONS))
        return [Pages(k, at, min(step, end - at)) for k, (start, end) in spans.items() for at in range(start, end, step)]

    def read(self, pages: Pages) -> Iterator[tuple]:
        fetch = _named(self.options["fetch"])
        end = pages.offset + pages.size
        for at in range(pages.offset, end, self.size):
            try:
                rows = fetch(pages.key, at, min(self.size, end - at), **self.more)
            except Exception as e:  # one page's failure is a row, the others go on
                yield pages.key, at, None, f"{type(e).__name__}: {e}"
                continue
            for r in rows:
                yield pages.key, at, json.dumps(r, ensure_ascii=False), None


class PagedReader(_Pages, DataSourceReader):
    def partitions(self) -> list[Pages]:
        pages = max(1, -(-int(self.options.get("total", 1)) // self.size))
        return self.dealt({k: (0, pages * self.size) for k in self.keys})


class PolledReader(_Pages, DataSourceStreamReader):
    def __init__(self, options: dict):
        super().__init__(options)
        self.at: dict | None = None  # what is taken, as far as this reader was told

    def initialOffset(self) -> dict:
        return dict.fromkeys(self.keys, 0)

    def latestOffset(self) -> dict:
        upto = _named(self.options["upto"])
        there = {k: int(upto(k, **self.more)) for k in self.keys}
        if self.at is None:  # not told yet: all there is, as a smaller offset than the logged one would go back
            return there
        left, out = int(self.options.get("limit", 1 << 30)), {}
        for k in self.keys:
            pages = min(left, -(-max(0, there[k] - self.at.get(k, 0)) // self.size))
            out[k] = max(self.at.get(k, 0), min(there[k], self.at.get(k, 0) + pages * self.size))
            left -= pages
        return out

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        self.at = {k: int(end.get(k, 0)) for k in self.keys}
        return self.dealt({k: (at, self.at[k]) for k in self.keys if (at := int(start.get(k, 0))) < self.at[k]})

    def commit(self, end: dict) -> None:
        self.at = {k: int(end.get(k, 0)) for k in self.keys}


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "key string, page int, row string, error string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)

    def streamReader(self, schema) -> PolledReader:
        return PolledReader(self.options)


def _lines(key: str, folder: str) -> list[tuple[int, str]]:
    """The files of a key, ``folder/key=.../from=...``, by the number of the first row of each."""
    store, root = fs.FileSystem.from_uri(folder)
    found = store.get_file_info(fs.FileSelector(f"{root}/key={key}", recursive=True))
    return sorted((int(f.path.rsplit("/from=", 1)[1].split("/")[0]), f.path) for f in found if f.is_file and f.path.endswith(".json"))


def _lines_of(key: str, offset: int, end: int, folder: str, stored: int) -> list[tuple[int, str]]:
    """Those of a key's files that hold rows of a page, where each but the last has ``stored`` rows: by their names, without a look at the others."""
    store, root = fs.FileSystem.from_uri(folder)
    out = []
    for first in range(offset // stored * stored, end, stored):
        found = store.get_file_info(fs.FileSelector(f"{root}/key={key}/from={first}", allow_not_found=True))
        out += [(first, f.path) for f in found if f.is_file and f.path.endswith(".json")]
    if not out:
        store.get_file_info(fs.FileSelector(f"{root}/key={key}/from=0"))  # a key without any is an error
    return out


def stored_page(key: str, offset: int, size: int, folder: str, stored: str | None = None) -> list[dict]:
    """Rows ``offset`` to ``offset + size`` of a key from JSON lines below a shared folder; a key without any is an error.

    ``stored`` is the number of rows of a file, if all but a key's last have as many; else the key's files are listed for every page.
    """
    store, _ = fs.FileSystem.from_uri(folder)
    out: list[dict] = []
    for first, path in _lines_of(key, offset, offset + size, folder, int(stored)) if stored else _lines(key, folder):
        if first < offset + size:
            with store.open_input_stream(path) as src:
                rows = [json.loads(x) for x in src.read().decode().splitlines()]
            out += [r for i, r in enumerate(rows, first) if offset <= i < offset + size]
    return out


def stored_count(key: str, folder: str, stored: str | None = None) -> int:
    store, _ = fs.FileSystem.from_uri(folder)
    try:
        files = _lines(key, folder)
    except FileNotFoundError:
        return 0
    if not files:
        return 0
    with store.open_input_stream(files[-1][1]) as src:
        return files[-1][0] + len(src.read().decode().splitlines())
