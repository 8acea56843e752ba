"""Paged REST source (S17) as a Python data source.

Each input partition fetches a contiguous range of pages, so pages are read in
parallel by the executors and nothing passes through the driver. A page is a
JSON array, an object holding the records under ``recordsPath``, or JSON lines.
Pages are named either by a URL template with ``{page}`` and a page count, or
by an explicit comma-separated URL list. A lower bound on the incremental
column (``since``) is sent as a request parameter (``sinceParam``); the caller
still filters the rows, so a server that ignores the parameter gives the same
answer.

``rest_cursor`` is the streamed form for an API that names each next page inside a page: see
``RestCursorReader``.

Options of ``rest_pages``: url | urls, pages, pagesPerPartition (default 4), recordsPath
(default ``records``), headers (JSON object), since, sinceParam, timeout (seconds).
"""

from __future__ import annotations

import json
from datetime import date, datetime
from urllib.parse import urlencode

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

FORMAT = "rest_pages"
CURSOR_FORMAT = "rest_cursor"


class Options(dict):
    """Reader options by name in any case: Spark hands them over in lower case."""

    def __init__(self, given):
        super().__init__({k.lower(): v for k, v in dict(given).items()})

    def __getitem__(self, name):
        return super().__getitem__(name.lower())

    def __contains__(self, name):
        return super().__contains__(name.lower())

    def get(self, name, default=None):
        return super().get(name.lower(), default)


class PageRange(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


def _records(text: str, path: str):
    text = text.strip()
    if not text:
        return []
    if text[0] in "[{":
        try:
            doc = json.loads(text)
        except json.JSONDecodeError:
            doc = None
        if isinstance(doc, list):
            return doc
        if isinstance(doc, dict):
            if path and path.split(".")[0] not in doc:
                return [doc]  # one record on a line, not an envelope
            for part in path.split(".") if path else []:
                doc = doc.get(part, []) if isinstance(doc, dict) else []
            return doc if isinstance(doc, list) else [doc]
    return [json.loads(line) for line in text.splitlines() if line.strip()]


def _convert(value, dtype):
    if value is None:
        return None
    if isinstance(dtype, (TimestampNTZType, TimestampType)) and isinstance(value, str):
        return datetime.fromisoformat(value)
    if isinstance(dtype, DateType) and isinstance(value, str):
        return date.fromisoformat(value)
    return value


def _fetch(url: str, options: dict) -> str:
    import urllib.request

    req = urllib.request.Request(url, headers=json.loads(options.get("headers", "{}")))
    with urllib.request.urlopen(req, timeout=float(options.get("timeout", "60"))) as resp:
        return resp.read().decode("utf-8")


def _rows(url: str, options: dict, schema: StructType):
    """Records of a page as tuples in the order of ``schema``."""
    for rec in _records(_fetch(url, options), options.get("recordsPath", "records")):
        yield tuple(_convert(rec.get(f.name), f.dataType) for f in schema.fields)


class RestPagesReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema = schema
        self.options = options

    def _urls(self) -> list[str]:
        if "urls" in self.options:
            return [u for u in self.options["urls"].split(",") if u]
        template, pages = self.options["url"], int(self.options["pages"])
        return [template.replace("{page}", str(i)) for i in range(pages)]

    def partitions(self):
        urls = self._urls()
        per = int(self.options.get("pagesPerPartition", "4"))
        return [PageRange(urls[i : i + per]) for i in range(0, len(urls), per)]

    def read(self, partition: PageRange):
        param, since = self.options.get("sinceParam"), self.options.get("since")
        for url in partition.urls:
            if param and since and not url.startswith("file:"):
                sep = "&" if "?" in url else "?"
                url = url + sep + urlencode({param: since})
            yield from _rows(url, self.options, self.schema)


class RestPages(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        if "schema" in self.options:
            return self.options["schema"]
        raise ValueError("rest_pages needs a schema (.schema(...) on the reader)")

    def reader(self, schema: StructType):
        return RestPagesReader(schema, Options(self.options))


class RestCursorReader(DataSourceStreamReader):
    """Stream over pages of which each names the next (S17): the offset is the last page planned.

    The driver follows the links from that page on, at most ``maxPages`` a trigger, and keeps only the links;
    tasks read the records, ``pagesPerPartition`` pages each. A page that later gains a next link is where the
    stream goes on. Every planned offset is kept in ``stateDir`` (a path of any file system that Arrow reads)
    before Spark logs it, so a restarted reader goes on from there: the links before it are not followed again,
    and which pages' records a batch holds is told by Spark's own offset log alone.

    Options: url (first page), nextPath (default ``next``), stateDir, maxPages (default 1000), and those of
    ``rest_pages`` for records, headers and timeout.
    """

    def __init__(self, schema: StructType, options: dict):
        self.schema, self.options = schema, options
        self.chain: list[str] = []  # pages after ``self.start``, as far as planned
        self.start: str | None = None

    def _state(self):
        from pyarrow import fs

        uri = self.options["stateDir"]  # Hadoop writes a local path as file:/path
        return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)

    def _planned(self) -> str:
        """The last page planned before this reader was made; empty at first."""
        from pyarrow import fs

        if "stateDir" not in self.options:
            return ""
        files, folder = self._state()
        if files.get_file_info(f"{folder}/planned").type == fs.FileType.NotFound:
            return ""
        with files.open_input_stream(f"{folder}/planned") as f:
            return f.read().decode("utf-8")

    def _keep(self, page: str) -> None:
        if "stateDir" in self.options:
            files, folder = self._state()
            files.create_dir(folder, recursive=True)
            with files.open_output_stream(f"{folder}/planned.new") as f:
                f.write(page.encode("utf-8"))
            files.move(f"{folder}/planned.new", f"{folder}/planned")

    def _after(self, page: str) -> str:
        """The page after one (the first after none); empty at the end."""
        if not page:
            return self.options["url"]
        value = json.loads(_fetch(page, self.options))
        for part in self.options.get("nextPath", "next").split("."):
            value = value.get(part) if isinstance(value, dict) else None
        return value or ""

    def initialOffset(self) -> dict:
        return {"page": ""}

    def latestOffset(self) -> dict:
        if self.start is None:
            self.start = self._planned()
        last = self.chain[-1] if self.chain else self.start
        for _ in range(int(self.options.get("maxPages", "1000"))):
            following = self._after(last)
            if not following:
                break
            self.chain.append(following)
            last = following
        self._keep(last)
        return {"page": last}

    def partitions(self, start: dict, end: dict):
        pages, page = [], start["page"]
        if page == end["page"]:
            return []
        known = [self.start, *self.chain] if self.start is not None else []
        if page in known and end["page"] in known:
            pages = known[known.index(page) + 1 : known.index(end["page"]) + 1]
        else:  # a batch of before the restart
            while page != end["page"]:
                page = self._after(page)
                if not page:
                    raise ValueError(f"no way from page {start['page']!r} to {end['page']!r}")
                pages.append(page)
        per = int(self.options.get("pagesPerPartition", "4"))
        return [PageRange(pages[i : i + per]) for i in range(0, len(pages), per)]

    def read(self, partition: PageRange):
        for url in partition.urls:
            yield from _rows(url, self.options, self.schema)

    def commit(self, end: dict) -> None:
        if end["page"] in self.chain:
            at = self.chain.index(end["page"])
            self.start, self.chain = end["page"], self.chain[at + 1 :]


class RestCursor(DataSource):
    @classmethod
    def name(cls):
        return CURSOR_FORMAT

    def schema(self):
        raise ValueError("rest_cursor needs a schema (.schema(...) on the reader)")

    def streamReader(self, schema: StructType):
        return RestCursorReader(schema, Options(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RestPages)
    spark.dataSource.register(RestCursor)


def stream_rest(spark: SparkSession, schema, **options):
    """S17 as a stream: ``stream_rest(spark, ddl, url=..., stateDir=...)``."""
    register(spark)
    return spark.readStream.format(CURSOR_FORMAT).schema(schema).options(**{k: str(v) for k, v in options.items()}).load()


def read_rest(spark: SparkSession, schema, **options):
    """``read_rest(spark, ddl, url=..., pages=..., pagesPerPartition=...)``."""
    register(spark)
    return spark.read.format(FORMAT).schema(schema).options(**{k: str(v) for k, v in options.items()}).load()
