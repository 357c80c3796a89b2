"""The wiki's API as data: requests, classification of answers, pages from JSON, and a Python data source.

The HTTP client is injected: a callable ``get(url) -> (status, headers, text)``
that executors can import. Nothing here opens a connection by itself.
"""

from __future__ import annotations

import importlib
import json
import math
import random
import time
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from email.utils import parsedate_to_datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import config as C
from ..functions import names
from ..operators.filters import redirect_target

Get = Callable[[str], tuple[int, dict, str]]

#: API errors that stand for an empty answer, and the sign of a log-in page (within its first characters): fixed values.
TOLERATED = ("missingtitle", "nosuchpageid")
AUTH_MARK, AUTH_CHARS, RETRY_AFTER = "未授权操作", 500, 5.0

PAGE_JSON = (
    "struct<query:struct<redirects:array<struct<`from`:string,`to`:string>>,pages:map<string,struct<title:string,pageid:bigint,lastrevid:bigint,touched:string,"
    "missing:string,categories:array<struct<title:string>>,extract:string>>>>"
)


def classify(status: Column, body: Column) -> Column:
    """What an answer is: ok, rate_limit (429), server_error (5xx), http_error, auth_page."""
    return (
        F.when(status == 429, "rate_limit").when(status >= 500, "server_error").when(status != 200, "http_error")
        .when(F.contains(F.substring(body, 1, AUTH_CHARS), F.lit(AUTH_MARK)), "auth_page").otherwise("ok")
    )


def api_error(body: Column) -> Column:
    """The code of an API error; null if there is none or if it only says that the page is missing."""
    code = F.get_json_object(body, "$.error.code")
    return F.when(~code.isin(*TOLERATED), code)


def failure(status: Column, body: Column) -> Column:
    """Why an answer is none: rate_limit, server_error, http_error, auth_page, or the code of an API error; null if it is one."""
    kind = classify(status, body)
    return F.when(kind != "ok", kind).otherwise(api_error(body))


def pages_from_json(answers: DataFrame, json_col: str = "json", base: str = C.BASE_URL) -> DataFrame:
    """Pages of API answers; missing pages give no row, bad dates are null, redirects show their target."""
    p = answers.select(F.from_json(json_col, PAGE_JSON).alias("a")).select(F.explode(F.map_values("a.query.pages")).alias("p")).where("p.missing IS NULL")
    title = F.col("p.title")
    categories = F.transform(F.coalesce("p.categories", F.array().cast("array<struct<title:string>>")), lambda c: F.regexp_replace(c["title"], "^Category:", ""))
    return p.select(
        title.alias("title"), F.coalesce("p.pageid", F.lit(0)).cast("long").alias("page_id"), F.coalesce("p.lastrevid", F.lit(0)).cast("long").alias("revision_id"),
        F.try_to_timestamp("p.touched").alias("updated"), categories.alias("categories"), F.coalesce("p.extract", F.lit("")).alias("wikitext"),
        names.page_url(title, base).alias("url"), redirect_target(F.coalesce("p.extract", F.lit(""))).alias("redirect_target"),
    )


def redirects_from_json(answers: DataFrame, json_col: str = "json") -> DataFrame:
    """(from, to) of the redirects that answers report."""
    return answers.select(F.explode(F.from_json(json_col, PAGE_JSON)["query"]["redirects"]).alias("r")).select("r.from", "r.to")


def prefer_batch(batch: DataFrame, single: DataFrame) -> DataFrame:
    """Pages of a batch request; those whose text came back empty are taken from single requests."""
    s = single.select(F.col("title").alias("single_title"), F.col("wikitext").alias("single_text"))
    out = batch.join(s, F.col("title") == F.col("single_title"), "left")
    return out.withColumn("wikitext", F.when(F.coalesce("wikitext", F.lit("")) == "", F.coalesce("single_text", F.lit(""))).otherwise(F.col("wikitext"))).select(*batch.columns)


def refetched(answers: DataFrame, single: DataFrame) -> DataFrame:
    """Pages of batch answers (json), redirects resolved: what came back empty is taken from single answers (title, json)."""
    batch = pages_from_json(answers)
    return prefer_batch(batch, pages_from_json(single))


class Limiter:
    """A least gap between requests with jitter, within one reader."""

    def __init__(self, gap: float = 0.5, jitter: float = 0.5, clock=time.monotonic, sleep=time.sleep):
        self.gap, self.jitter, self.clock, self.sleep, self.last = gap, jitter, clock, sleep, -1e9

    def wait(self) -> float:
        pause = max(0.0, self.last + self.gap - self.clock()) + random.uniform(0, self.jitter)
        if pause > 0:
            self.sleep(pause)
        self.last = self.clock()
        return pause


class Slots:
    """One rate for several streams of requests, wherever they run.

    Time from a common start is cut into slots, dealt out to the streams in
    turn; a stream asks once in a slot of its own, and one that is late takes
    its next. A slot is a gap long and half the jitter, and the moment within
    that half is random, so no two requests of all streams are closer than the
    gap, and on average they are as far apart as with one limiter. The clocks
    of the machines are taken to agree.
    """

    def __init__(self, start: float, stream: int = 0, streams: int = 1, gap: float = 0.5, jitter: float = 0.5, clock=time.time, sleep=time.sleep):
        self.jitter, self.clock, self.sleep = jitter / 2, clock, sleep
        slot = gap + self.jitter
        self.first, self.period, self.next = start + stream * slot, streams * slot, 0

    def wait(self) -> float:
        if self.period <= 0:
            return 0.0
        now = self.clock()
        k = max(self.next, math.ceil((now - self.first) / self.period))
        self.next = k + 1
        pause = max(0.0, self.first + k * self.period + random.uniform(0, self.jitter) - now)
        if pause:
            self.sleep(pause)
        return pause


def ask(get: Get, url: str, settings: C.Settings = C.Settings(), sleep=time.sleep) -> tuple[int, str, int]:
    """(status, text, attempts) of a request that is repeated until the answer is neither a rate limit nor a server error, at most ``attempts`` times.

    Waits double from one second up to the longest wait, with jitter; a rate
    limit's Retry-After is heeded. Connection errors count as server errors.
    """
    status, text, attempt = 0, "", 0
    while attempt < settings.attempts:
        attempt += 1
        try:
            status, headers, text = get(url)
        except OSError:
            status, headers, text = 599, {}, ""
        if status != 429 and status < 500:
            break
        if attempt < settings.attempts:
            wait = min(settings.longest_wait, settings.first_wait * 2 ** (attempt - 1) + random.uniform(0, settings.retry_jitter))
            sleep(max(wait, retry_after(headers.get("Retry-After"))) if status == 429 else wait)
    return status, text, attempt


def with_retries(get: Get, url: str, settings: C.Settings = C.Settings(), sleep=time.sleep) -> tuple[int, str]:
    return ask(get, url, settings, sleep)[:2]


def retry_after(value: str | None, now: datetime | None = None) -> float:
    """Seconds that a Retry-After header asks for, as a number or as a date; the usual pause if it is missing or unreadable."""
    if not value:
        return RETRY_AFTER
    try:
        return max(0.0, float(value))
    except ValueError:
        pass
    try:
        when = parsedate_to_datetime(value)
    except ValueError:
        return RETRY_AFTER
    when = when if when.tzinfo else when.replace(tzinfo=timezone.utc)
    return max(0.0, (when - (now or datetime.now(timezone.utc))).total_seconds())


def wait_bounds(attempt: Column, settings: C.Settings = C.Settings()) -> tuple[Column, Column]:
    """The least and the greatest number of seconds that are waited after a failed attempt, counted from 1; none after the last."""
    least, cap = F.pow(F.lit(2.0), attempt - 1) * settings.first_wait, F.lit(float(settings.longest_wait))
    more = attempt < settings.attempts
    return F.when(more, F.least(least, cap)), F.when(more, F.least(least + settings.retry_jitter, cap))


def _client(path: str) -> Get:
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


class _Titles(InputPartition):
    def __init__(self, urls: list[str], stream: int, streams: int):
        super().__init__(urls)
        self.urls, self.stream, self.streams = urls, stream, streams


class WikiReader(DataSourceReader):
    """Fetches addresses, a bounded number of partitions at a time, all at one rate."""

    def __init__(self, options: dict):
        self.options = options
        self.gap, self.jitter = float(options.get("gap", 0.5)), float(options.get("jitter", 0.5))
        self.start = time.time() + self.gap

    def partitions(self) -> list[InputPartition]:
        urls = json.loads(self.options["urls"])
        n = max(1, min(int(self.options.get("concurrent", C.Settings().max_concurrent)), len(urls)))
        return [_Titles(urls[i::n], i, n) for i in range(n)]

    def read(self, partition: _Titles) -> Iterator[tuple]:
        get = _client(self.options["client"])
        slots = Slots(self.start, partition.stream, partition.streams, self.gap, self.jitter)

        def paced(url: str) -> tuple[int, dict, str]:
            slots.wait()
            return get(url)

        for url in partition.urls:
            yield (url, *with_retries(paced, url))


class WikiSource(DataSource):
    """``spark.read.format("quernstone_wiki")``: options urls (JSON list), client (``module:function``), concurrent, gap, jitter."""

    @classmethod
    def name(cls) -> str:
        return "quernstone_wiki"

    def schema(self) -> str:
        return "url string, status int, body string"

    def reader(self, schema) -> DataSourceReader:
        return WikiReader(self.options)


def fetch(spark: SparkSession, urls: list[str], client: str, **options) -> DataFrame:
    """(url, status, body, outcome) of addresses, fetched by executors."""
    spark.dataSource.register(WikiSource)
    reader = spark.read.format("quernstone_wiki").option("urls", json.dumps(urls)).option("client", client)
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return reader.load().withColumn("outcome", classify(F.col("status"), F.col("body")))


def listing_members(get: Get, category: str, settings: C.Settings = C.Settings(), parse=None, sleep=time.sleep, limiter: Limiter | None = None) -> Iterator[dict]:
    """The members of a category, page by page, until there is no next page, no member, no mark to go on from, or an error.

    ``parse(html) -> (members, next address)``. A page whose members are all
    filtered ends the listing in strict mode. Every request waits for the
    limiter, and a repeated one as long as retries do.
    """
    from urllib.parse import parse_qs, quote, urlsplit

    limiter = limiter or Limiter(settings.rate_limit, sleep=sleep)

    def paced(address: str) -> tuple[int, dict, str]:
        limiter.wait()
        return get(address)

    url = f"{settings.base_url}/{category.replace(' ', '_')}"
    while url:
        status, text = with_retries(paced, url, settings, sleep=sleep)
        if status != 200:
            return
        members, following = parse(text)
        yield from members
        if (settings.strict and not members) or not following:
            return
        mark = parse_qs(urlsplit(following).query).get("pagefrom", [""])[0]
        url = f"{settings.base_url}/{category.replace(' ', '_')}?pagefrom={quote(mark)}" if mark else ""
