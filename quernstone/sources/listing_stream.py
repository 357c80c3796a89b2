"""Category listings as a stream: a micro-batch fetches the next listing page of each category.

Offsets count the pages of each category. A task stores the page that it has
fetched, and the mark of the next one, below a shared folder before it hands
the page on; so a listing that was stopped goes on after its last page, and a
batch that is run again takes its pages from the folder and asks for none
twice. The folder belongs to the stream's checkpoint.
"""

from __future__ import annotations

import html
import json
import re
import time
from collections.abc import Iterator
from urllib.parse import parse_qs, quote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .. import config as C
from . import api, files
from .listing import NEXT_LINK

_NEXT = re.compile(rf'<a\b[^>]*\bhref="([^"]*)"[^>]*>[^<]*{NEXT_LINK}[^<]*</a>')


def next_mark(page: str) -> str:
    """The mark from which the listing goes on after a page; empty at its end."""
    found = _NEXT.search(page)
    return parse_qs(urlsplit(html.unescape(found[1])).query).get("pagefrom", [""])[0] if found else ""


class _Page(InputPartition):
    def __init__(self, number: int, category: str, page: int, stream: int, streams: int, start: float):
        super().__init__((number, page))
        self.number, self.category, self.page, self.stream, self.streams, self.start = number, category, page, stream, streams, start


class ListingStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.categories, self.root, self.client = json.loads(options["categories"]), options["path"], options["client"]
        self.base, self.gap, self.jitter = options.get("base", C.BASE_URL), float(options.get("gap", 0.5)), float(options.get("jitter", 0.5))

    def _mark(self, number: int, page: int) -> str | None:
        """The mark that a stored page ends with; None for a page that is not stored."""
        try:
            return files.get(self.root, f"{number:06d}/{page:08d}.next").decode()
        except FileNotFoundError:
            return None

    def initialOffset(self) -> dict:
        return {c: 0 for c in self.categories}

    def latestOffset(self) -> dict:
        """For each category the pages that are stored, and one more unless the last was the end."""
        out = {}
        for i, c in enumerate(self.categories):
            done = files.count_files(self.root, f"{i:06d}", ".next")
            out[c] = done + 1 if not done or self._mark(i, done) else done
        return out

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        wanted = [(i, c, p) for i, c in enumerate(self.categories) for p in range(start.get(c, 0) + 1, end.get(c, 0) + 1)]
        begin = time.time() + self.gap
        return [_Page(*w, k, len(wanted), begin) for k, w in enumerate(wanted)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        name = f"{partition.number:06d}/{partition.page:08d}"
        if self._mark(partition.number, partition.page) is None:
            mark = self._mark(partition.number, partition.page - 1) if partition.page > 1 else ""
            url = f"{self.base}/{partition.category.replace(' ', '_')}" + (f"?pagefrom={quote(mark)}" if mark else "")
            get, slots = api._client(self.client), api.Slots(partition.start, partition.stream, partition.streams, self.gap, self.jitter)

            def paced(address: str) -> tuple[int, dict, str]:
                slots.wait()
                return get(address)

            status, page = api.with_retries(paced, url)
            if status != 200:
                raise OSError(f"{url}: {status}")
            files.put(self.root, f"{name}.html", page)
            files.put(self.root, f"{name}.next", next_mark(page))
        yield (partition.category, partition.page, files.get(self.root, f"{name}.html").decode())

    def commit(self, end: dict) -> None:
        pass


class ListingStreamSource(DataSource):
    """``spark.readStream.format("quernstone_listing_stream")``: options categories (JSON list), client (``module:function``), path (a shared folder), base, gap, jitter."""

    @classmethod
    def name(cls) -> str:
        return "quernstone_listing_stream"

    def schema(self) -> str:
        return "category string, page int, html string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ListingStreamReader(self.options)


def stream_listings(spark: SparkSession, categories: list[str], client: str, path: str, settings: C.Settings = C.Settings()) -> DataFrame:
    """(category, page, html) of the listing pages of some categories as a stream; :func:`quernstone.sources.listing.members` takes it."""
    spark.dataSource.register(ListingStreamSource)
    reader = spark.readStream.format("quernstone_listing_stream").option("categories", json.dumps(categories)).option("client", client).option("path", path)
    return reader.option("base", settings.base_url).option("gap", str(settings.rate_limit)).option("jitter", str(settings.jitter)).load()
