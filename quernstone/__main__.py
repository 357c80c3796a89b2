"""``python -m quernstone crawl CLIENT CACHE | update CLIENT CACHE | clean-cache CACHE | cache-stats CACHE | index KB_DIR INDEX | ask KB_DIR_OR_INDEX MESSAGE | stats KB_DIR | quality KB_DIR REPORT_DIR | clean DIR``.

CLIENT is ``module:function``, a callable ``get(url) -> (status, headers, text)``; CACHE is a folder that holds the page table; INDEX one that holds a search index.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config, storage
from .operators import index, postings, reports, stats
from .plans import crawl as jobs
from .plans import live
from .services import Engine
from .sources import files

COMMANDS = (
    ("crawl", ("client", "cache")), ("update", ("client", "cache")), ("clean-cache", ("cache",)), ("cache-stats", ("cache",)),
    ("index", ("kb", "index")), ("ask", ("kb", "message")), ("stats", ("kb",)), ("quality", ("kb", "report")), ("clean", ("dir",)),
)


def cached_pages(spark: SparkSession, cache: str) -> DataFrame | None:
    """The cached pages; None for an empty cache."""
    return live.Cache(spark, cache).pages()


def crawl(spark: SparkSession, client: str, cache: str, settings: config.Settings) -> DataFrame:
    """A crawl into cache and output folder, or what an interrupted one left; (position, metric, value) of the run."""
    with live.Interrupt(spark) as stop:
        result = live.run_crawl(spark, client, settings, cache, stop)
        if not stop.asked:
            live.save(result, settings)
    return stats.summary(result.counters)


def update(spark: SparkSession, client: str, cache: str, settings: config.Settings) -> DataFrame:
    """An incremental update of the cache (a full crawl if it is empty); actions by number of pages."""
    if cached_pages(spark, cache) is None:
        return crawl(spark, client, cache, settings)
    return jobs.action_counts(live.run_update(spark, client, settings, cache))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quernstone", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, args in COMMANDS:
        sub = commands.add_parser(name)
        for a in args:
            sub.add_argument(a)
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("quernstone").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    settings = config.from_env()
    if a.command == "crawl":
        crawl(spark, a.client, a.cache, settings).show(truncate=False)
    elif a.command == "update":
        update(spark, a.client, a.cache, settings).show(truncate=False)
    elif a.command == "cache-stats":
        pages = cached_pages(spark, a.cache)
        if pages is not None:
            categories = pages.select(F.explode("categories").alias("title")).distinct()
            stats.summary(stats.table_counts(pages, categories), stats.CACHE_SUMMARY).show(truncate=False)
    elif a.command == "ask":
        stored = storage.Manifests(spark, a.kb).versions()
        entries = postings.StoredIndex(spark, a.kb) if stored else index.build_index(files.read_markdown(spark, config.resolve_kb_path(a.kb)))
        print(Engine(entries).ask(a.message)[1])
    elif a.command == "index":
        print(postings.build(index.build_index(files.read_markdown(spark, a.kb)), a.index))
        postings.remove_old(spark, a.index)
    elif a.command == "stats":
        index.bucket_counts(index.build_index(files.read_markdown(spark, a.kb))).show()
    elif a.command == "quality":
        found = files.read_markdown(spark, a.kb, None)
        for name, report in (("quality_report", reports.scan_report), ("deep_scan_report", reports.deep_report), ("auto_fix_report", reports.repair_log)):
            files.write_report(reports.numbered(report(found)), f"{a.report}/{name}.txt")
    else:
        files.clean_output(spark, a.cache if a.command == "clean-cache" else a.dir)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
