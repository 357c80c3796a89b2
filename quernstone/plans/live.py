"""A crawl over a live wiki: listings, fetches, parsing and sinks in one job that can be interrupted and taken up again.

The HTTP client is named as ``module:function`` and runs on executors; the
driver holds titles of one level at most as table rows, never as a list.
"""

from __future__ import annotations

import contextlib
import signal
import sys
import threading
import time
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..operators import merge, render, stats
from ..sources import api, files, listing
from ..sources.pagetable import PageTable
from ..storage import delete, materialize, names_in, scratch, shared_dir
from . import crawl as jobs

#: Columns of cached pages but for the times; attempts is how often a failed page was asked for in the last run.
COLUMNS = {
    "title": "string", "page_id": "long", "revision_id": "long", "updated": "timestamp", "categories": "array<string>", "wikitext": "string", "markdown": "string", "url": "string",
    "redirect_target": "string", "status": "string", "error": "string", "display_title": "string", "skip_reason": "string", "attempts": "int",
}
#: What an API request asks for: fixed values.
API_QUERY = "?action=query&format=json&redirects=1&prop=revisions%7Cinfo%7Ccategories%7Cextracts&explaintext=1&cllimit=max&titles="


class Interrupt:
    """The first signal ends the Spark jobs of the step at hand and asks the run to stop; what was committed before stays. The second ends the program."""

    def __init__(self, spark: SparkSession | None = None):
        self.asked, self.context, self.tag = False, spark.sparkContext if spark else None, f"quernstone-{uuid.uuid4().hex}"

    def __call__(self, *_: object) -> None:
        if self.asked:
            sys.exit(1)
        self.asked = True
        if self.context is not None:  # not on this thread, which may be waiting for the very job
            threading.Thread(target=self.context.cancelJobsWithTag, args=(self.tag,), daemon=True).start()

    def __enter__(self) -> Interrupt:
        self.old = {s: signal.signal(s, self) for s in (signal.SIGINT, signal.SIGTERM)}
        return self

    def __exit__(self, *_: object) -> None:
        for s, old in self.old.items():
            signal.signal(s, old)

    @contextlib.contextmanager
    def step(self):
        """A step that may be cut off: its jobs are tagged, and if a signal ends them the step is given up without an error."""
        if self.context is not None:
            self.context.addJobTag(self.tag)
        try:
            yield
        except Exception:
            if not self.asked:
                raise
        finally:
            if self.context is not None:
                self.context.removeJobTag(self.tag)


class Cache:
    """The page table and the waves that a crawl has fetched since: each wave is complete or absent, and is merged into the table later."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table, self.waves = spark, PageTable(spark, path), f"{path.rstrip('/')}/waves"

    def add(self, rows: DataFrame) -> None:
        """Commit a wave. It costs what its rows cost, however large the table is."""
        rows.write.parquet(f"{self.waves}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")

    def absorb(self, now: Column | None = None) -> None:
        """Merge all complete waves into the table, later ones over earlier ones; incomplete ones go."""
        found = names_in(self.spark, self.waves)
        whole = [n for n in found if "_SUCCESS" in names_in(self.spark, f"{self.waves}/{n}")]
        if whole:
            rows = self.spark.read.option("mergeSchema", "true").parquet(*(f"{self.waves}/{n}" for n in whole))
            name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
            rows = merge.latest(rows.withColumn("wave__", name), "title", "wave__").drop("wave__").select(*(F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in COLUMNS.items()))
            now = F.current_timestamp() if now is None else now
            if self.table.exists():
                self.table.merge(rows, lambda old, new: merge.upsert(old, new, "title", now))
            else:
                self.table.replace(rows.withColumns({"created_at": now, "updated_at": now}))
        for n in found:
            delete(self.spark, f"{self.waves}/{n}")

    def pages(self) -> DataFrame | None:
        """All pages; None for an empty cache."""
        self.absorb()
        return self.table.read() if self.table.exists() else None


def fetch_urls(urls: DataFrame, client: str, settings: Settings = Settings()) -> DataFrame:
    """(url, status, body, attempts, outcome) of a table (url): at most ``max_concurrent`` streams of requests, at one rate together, retries included."""
    streams, start = settings.max_concurrent, time.time() + settings.rate_limit

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get, slots = api._client(client), api.Slots(start, TaskContext.get().partitionId() % streams, streams, settings.rate_limit, settings.jitter)

        def paced(url: str):
            slots.wait()
            return get(url)

        for rows in batches:
            answers = [api.ask(paced, u, settings) for u in rows["url"]]
            yield pd.DataFrame({"url": rows["url"]} | {c: [a[i] for a in answers] for i, c in enumerate(("status", "body", "attempts"))})

    out = urls.select("url").repartition(streams).mapInPandas(run, "url string, status int, body string, attempts int")
    return out.withColumn("outcome", api.classify(F.col("status"), F.col("body")))


def list_edges(spark: SparkSession, client: str, settings: Settings, stop: Interrupt) -> DataFrame:
    """(parent, title, page_type) of all listing pages that the root reaches, level by level, each with its next pages."""
    base = F.lit(settings.base_url + "/")
    level = spark.createDataFrame([(settings.root_category,)], "title string")
    visited, edges = level, None
    for depth in range(settings.max_depth + 1):
        todo = level.select(F.col("title").alias("category"), F.concat(base, F.replace("title", F.lit(" "), F.lit("_"))).alias("url"))
        found = None
        while not stop.asked and not todo.isEmpty():
            got = materialize(fetch_urls(todo, client, settings).where("outcome = 'ok'").join(todo, "url").select("category", F.col("body").alias("html")), f"listing{depth}")
            members = listing.members(got)
            found = members if found is None else found.unionByName(members)
            mark = listing.page_from(listing.next_url(F.col("html"), settings.base_url))
            more = got.withColumn("mark", mark).where("mark IS NOT NULL AND mark <> ''")
            if settings.strict:  # a page without members ends its listing
                more = more.join(members.select(F.col("parent").alias("category")).distinct(), "category", "left_semi")
            todo = materialize(more.select("category", F.concat(base, F.replace("category", F.lit(" "), F.lit("_")), F.lit("?pagefrom="), F.url_encode("mark")).alias("url")), f"next{depth}")
        if found is None:
            break
        found = materialize(found, f"edges{depth}")
        edges = found if edges is None else edges.unionByName(found)
        level = materialize(found.where("page_type = 'subcat'").select("title").distinct().join(visited, "title", "left_anti"), f"level{depth}")
        visited = visited.unionByName(level)
        if stop.asked or level.isEmpty():
            break
    return edges if edges is not None else spark.createDataFrame([], "parent string, title string, page_type string")


def fetch_pages(titles: DataFrame, client: str, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Pages by API, and what became of the titles that gave none: (title, error, attempts).

    Titles are asked for in batches, and again singly those whose text came
    back empty. An error is the kind of the failed answer, the API's code, or
    ``missing`` where an answer has no such page, redirects followed.
    """
    numbered = titles.select("title", F.xxhash64("title").alias("page_id"))
    address = F.concat(F.lit(settings.api_url + API_QUERY), F.url_encode("titles"))
    asked = materialize(merge.batches(numbered, settings.titles_per_request).select("titles", address.alias("url")), "asked")
    answers = materialize(fetch_urls(asked, client, settings).withColumn("code", api.failure(F.col("status"), F.col("body"))), "answers")
    good = answers.where("code IS NULL")
    pages = materialize(api.pages_from_json(good, "body", settings.base_url), "batch")
    again = fetch_urls(pages.where("wikitext = ''").select(F.col("title").alias("titles")).select(address.alias("url")), client, settings)
    single = materialize(again.where(api.failure(F.col("status"), F.col("body")).isNull()), "single")

    by_title = asked.join(answers.select("url", "code", "attempts"), "url").select(F.explode(F.split("titles", r"\|")).alias("title"), "code", "attempts")
    resolved = merge.resolve_redirects(by_title, api.redirects_from_json(good, "body").distinct())
    failed = resolved.join(pages.select(F.col("title").alias("resolved_title")).distinct(), "resolved_title", "left_anti")
    failed = failed.select("title", F.coalesce("code", F.lit("missing")).alias("error"), "attempts")
    return api.prefer_batch(pages, api.pages_from_json(single, "body", settings.base_url)), failed


def fetch_wave(titles: DataFrame, client: str, settings: Settings = Settings()) -> DataFrame:
    """The rows of a wave of titles: pages that are completed or skipped, and failed ones with their error and attempts."""
    fetched, failed = fetch_pages(titles, client, settings)
    pages = jobs.process(fetched, settings).withColumn("attempts", F.lit(None).cast("int"))
    failed = failed.withColumn("status", F.lit("failed"))
    return pages.unionByName(failed, allowMissingColumns=True).select(*(F.col(c) if c in pages.columns else F.lit(None).cast(t).alias(c) for c, t in COLUMNS.items())).dropDuplicates(["title"])


def wanted_titles(discovered: DataFrame, cached: DataFrame | None) -> DataFrame:
    """(title, turn): titles that are not done, in the order in which a run asks for them: failed ones first, those that failed least often before others, then new ones by title."""
    if cached is None:
        known = discovered.select("title").distinct().withColumn("tries", F.lit(None).cast("int"))
    else:
        had = cached.select(F.col("title").alias("own"), "status", "attempts")
        known = discovered.select("title").distinct().join(had, F.col("title") == F.col("own"), "left").where("status IS NULL OR status NOT IN ('completed', 'skipped')")
        known = known.select("title", F.when(F.col("status").isNotNull(), F.coalesce("attempts", F.lit(0))).alias("tries"))
    return merge.numbered(known, F.col("tries").asc_nulls_last(), F.col("title").asc(), name="turn").drop("tries")


def fetch_in_waves(wanted: DataFrame, client: str, settings: Settings, cache: Cache, stop: Interrupt) -> int:
    """Fetch ``wanted`` (title, turn), ``fetch_batch`` titles at a time, each wave committed before the next is asked for; the number of waves committed."""
    waves = -(-((wanted.agg(F.max("turn").alias("n")).first()["n"] or -1) + 1) // settings.fetch_batch)
    done = 0
    for n in range(waves):
        if stop.asked:
            break
        with stop.step():
            some = wanted.where((F.col("turn") >= n * settings.fetch_batch) & (F.col("turn") < (n + 1) * settings.fetch_batch))
            with scratch(wanted.sparkSession):
                cache.add(fetch_wave(some.select("title"), client, settings))
            done += 1
    return done


def run_crawl(spark: SparkSession, client: str, settings: Settings = Settings(), cache: str | None = None, stop: Interrupt | None = None) -> jobs.Crawl:
    """Discover, fetch in waves what the cache (a folder) has not done, parse, and give pages, files, index and counters of all.

    A run that is interrupted leaves the waves that it has committed; the next
    one asks for the rest.
    """
    stop = stop or Interrupt(spark)
    kept = Cache(spark, cache or f"{shared_dir(spark)}/quernstone/{spark.sparkContext.applicationId}/cache-{uuid.uuid4().hex}")
    had = kept.pages()
    edges = None
    with stop.step():
        edges = materialize(list_edges(spark, client, settings, stop), "edges")
    if edges is not None and not stop.asked:
        wanted = materialize(wanted_titles(edges.where("page_type = 'page'"), had), "wanted")
        fetch_in_waves(wanted, client, settings, kept, stop)
    pages = kept.pages()
    if pages is None:
        pages = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in COLUMNS.items()) + ", created_at timestamp, updated_at timestamp")
    return jobs.outputs(pages, settings)


def run_update(spark: SparkSession, client: str, settings: Settings, cache: str) -> DataFrame:
    """Ask for all completed pages of a cache and merge what has changed, bucket by bucket; (title, action)."""
    kept = Cache(spark, cache)
    cached = kept.pages()
    with scratch(spark) as keep:
        fetched = fetch_pages(cached.where("status = 'completed'").select("title"), client, settings)[0]
        fresh = materialize(fetched, "fresh")
        _, actions = jobs.update(cached, fresh, F.current_timestamp(), settings)
        actions = keep(materialize(actions, "kept"))
        changed = fresh.join(actions.where("action IN ('updated', 'filtered')").select("title"), "title", "left_semi")
        kept.table.merge(changed, lambda old, new: jobs.update(old, new, F.current_timestamp(), settings)[0])
    return actions


def save(result: jobs.Crawl, settings: Settings, now: Column | None = None) -> DataFrame:
    """Write files, the index and the statistics below the output folder; (path, error) of the files."""
    root = settings.output_dir.rstrip("/")
    own = result.files.withColumn("path", F.regexp_replace("path", f"^{root}/", ""))
    done = materialize(files.export_files(own, root), "exported")
    exported = done.agg(F.count_if(F.col("error").isNull()).alias("exported_files"))
    skipped = render.export_counts(result.pages, result.files).select("skipped_files")
    files.write_json(result.index, "entry", f"{root}/_index.json", F.col("title"))
    files.write_document(stats.run_document(result.counters, exported.join(F.broadcast(skipped), F.lit(True))), "json", f"{root}/_crawl_stats.json", F.col("json"))  # one row each
    return done
