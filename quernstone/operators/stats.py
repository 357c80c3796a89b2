"""Counters of a run and of the page table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTERS = ("total_pages", "pages_crawled", "pages_failed", "pages_skipped", "pages_filtered")
#: Saved statistics that a reload forgets, in strict mode.
FORGOTTEN = ("pages_filtered",)


def table_counts(pages: DataFrame, categories: DataFrame) -> DataFrame:
    """All pages, completed and failed ones, and categories; one pass over each."""
    p = pages.agg(F.count("*").alias("n_pages"), F.count_if(F.col("status") == "completed").alias("n_completed"), F.count_if(F.col("status") == "failed").alias("n_failed"))
    return p.join(F.broadcast(categories.agg(F.count("*").alias("n_categories"))), F.lit(True))  # one row each


def status_counts(pages: DataFrame) -> DataFrame:
    return pages.groupBy("status").agg(F.count("*").alias("n_pages"))


def run_counters(tagged: DataFrame) -> DataFrame:
    """Counters of pages with status and skip_reason."""
    done, skipped = F.col("status") == "completed", F.col("status") == "skipped"
    return tagged.agg(
        F.count("*").alias("total_pages"), F.count_if(done).alias("pages_crawled"), F.count_if(F.col("status") == "failed").alias("pages_failed"),
        F.count_if(skipped & F.col("redirect_target").isNotNull()).alias("pages_skipped"), F.count_if(skipped & F.col("redirect_target").isNull()).alias("pages_filtered"),
    )


def with_rates(counters: DataFrame) -> DataFrame:
    """elapsed_seconds and pages_per_second from start_time and end_time: 0 without a start or without time, two decimals."""
    seconds = (F.col("end_time").cast("double") - F.col("start_time").cast("double"))
    elapsed = F.when(F.col("start_time").isNull(), 0.0).otherwise(F.coalesce(seconds, F.lit(0.0)))
    rate = F.when(elapsed > 0, F.col("pages_crawled") / elapsed).otherwise(0.0)
    return counters.withColumns({"elapsed_seconds": F.bround(elapsed, 2), "pages_per_second": F.bround(rate, 2)})


def to_key_values(counters: DataFrame, names: tuple[str, ...] = COUNTERS) -> DataFrame:
    """(key, value): one row for each counter, as text."""
    pairs = F.array(*(F.struct(F.lit(n).alias("key"), F.col(n).cast("string").alias("value")) for n in names))
    return counters.select(F.explode(pairs).alias("x")).select("x.*")


def from_key_values(rows: DataFrame, names: tuple[str, ...] = COUNTERS, strict: bool = True) -> DataFrame:
    """Counters read back: missing or unreadable ones are 0; strict mode forgets some."""
    kept = [n for n in names if not (strict and n in FORGOTTEN)]
    value = F.col("value").try_cast("long")
    return rows.agg(*(F.coalesce(F.max(F.when(F.col("key") == n, value)), F.lit(0)).cast("long").alias(n) for n in kept))


def stats_json(counters: DataFrame) -> DataFrame:
    return counters.select(F.to_json(F.struct(*counters.columns), {"pretty": "true", "ignoreNullFields": "false"}).alias("json"))


def run_document(counters: DataFrame, exported: DataFrame) -> DataFrame:
    """(json): the counters of a run with the files that were written and skipped."""
    return stats_json(counters.join(F.broadcast(exported), F.lit(True)))  # one row each


#: Labels of the summary of a run, and of what a cache holds: fixed values.
SUMMARY = (("total_pages", "发现页面"), ("pages_crawled", "成功爬取"), ("pages_skipped", "跳过（未变更）"), ("pages_filtered", "过滤（非内容）"), ("pages_failed", "失败"))
CACHE_SUMMARY = (("n_pages", "已缓存页面数"), ("n_completed", "已完成页面数"), ("n_failed", "失败页面数"), ("n_categories", "已发现分类数"))


def summary(counts: DataFrame, labels: tuple[tuple[str, str], ...] = SUMMARY) -> DataFrame:
    """(position, metric, value): a table to show, labelled."""
    rows = F.array(*(F.struct(F.lit(label).alias("metric"), F.col(c).cast("string").alias("value")) for c, label in labels))
    return counts.select(F.posexplode(rows).alias("position", "x")).select(F.col("position").cast("long").alias("position"), "x.*")


def report(counters: DataFrame, names: tuple[str, ...] = COUNTERS) -> DataFrame:
    """(metric, value) for a summary table."""
    return to_key_values(counters, names).withColumnsRenamed({"key": "metric"})
