"""Keyed merges: upserts, revision-gated updates, redirects, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import materialize


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key: that with the greatest ``order`` (arrival)."""
    best = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("row"))
    return best.select("row.*")


def upsert(old: DataFrame, new: DataFrame, key: str, now: Column, created: str = "created_at", updated: str | None = "updated_at") -> DataFrame:
    """``old`` with ``new`` merged in by ``key``: new values win, nulls included; the creation time survives.

    ``new`` has one row for each key and the columns of ``old`` but for the
    times. One shuffle of each side; both sides may be skewed in size alone,
    as keys are unique.
    """
    n = new.select(*(F.col(c).alias(f"n__{c}") for c in new.columns))
    both = old.join(n, F.col(key) == F.col(f"n__{key}"), "full_outer")
    is_new = F.col(f"n__{key}").isNotNull()
    out = [F.when(is_new, F.col(f"n__{c}")).otherwise(F.col(c)).alias(c) for c in new.columns]
    out.append(F.coalesce(F.col(created), F.when(is_new, now)).alias(created))
    if updated:
        out.append(F.when(is_new, now).otherwise(F.col(updated)).alias(updated))
    return both.select(*out)


def upsert_categories(old: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """The category table (title, page_id, depth, parent, crawled, created_at) with new rows merged in; there is no time of change."""
    return upsert(old, new, "title", now, updated=None)


def update_actions(cached: DataFrame, fresh: DataFrame, skip_reason: Column | None = None) -> DataFrame:
    """What an incremental update does with each cached page: missing, unchanged, filtered or updated.

    ``fresh`` has title and revision_id (and what ``skip_reason`` reads, under
    its own names). A page without a fresh row is ``missing``; a revision that
    is not greater leaves it ``unchanged``.
    """
    f = fresh.select(F.col("title").alias("fresh_title"), F.col("revision_id").alias("fresh_revision"), *([skip_reason.alias("fresh_reason")] if skip_reason is not None else [F.lit(None).cast("string").alias("fresh_reason")]))
    joined = cached.join(f, F.col("title") == F.col("fresh_title"), "left")
    action = (
        F.when(F.col("fresh_title").isNull(), "missing")
        .when(~(F.col("fresh_revision") > F.col("revision_id")), "unchanged")
        .when(F.col("fresh_reason").isNotNull(), "filtered")
        .otherwise("updated")
    )
    return joined.withColumn("action", action).drop("fresh_title")


def resolve_redirects(titles: DataFrame, redirects: DataFrame, title_col: str = "title") -> DataFrame:
    """``titles`` with resolved_title; ``redirects`` has one row (from, to) for each source."""
    r = redirects.select(F.col("from").alias("redirect_from"), F.col("to").alias("redirect_to"))
    out = titles.join(r, F.col(title_col) == F.col("redirect_from"), "left")
    return out.withColumn("resolved_title", F.coalesce("redirect_to", title_col)).drop("redirect_from", "redirect_to")


def without_visited(rows: DataFrame, visited: DataFrame, key: str = "title") -> DataFrame:
    return rows.join(visited.select(key), key, "left_anti")


def numbered(rows: DataFrame, *order: Column, name: str = "place") -> DataFrame:
    """``rows`` with their places from 0 in the given order, which should leave no ties.

    Rows are cut into ranges by the order itself, numbered within their range,
    and the counts of the ranges before are added: as many as there are
    partitions. No task sorts all rows, and nulls have places like all others.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at__", F.monotonically_increasing_id())
    ranged = materialize(ranged, "ranged")
    rows, part = ranged, F.shiftright("at__", 33)
    counts = rows.groupBy(part.alias("part__")).agg(F.count("*").alias("n__"))
    before = counts.select("part__", F.coalesce(F.sum("n__").over(Window.orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before__"))
    out = rows.withColumn("part__", part).join(F.broadcast(before), "part__")  # a row for each partition
    return out.withColumn(name, F.col("at__").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("before__")).drop("part__", "at__", "before__")


def batches(titles: DataFrame, size: int = 20, title_col: str = "title", order_col: str = "page_id") -> DataFrame:
    """Requests for ``size`` titles at a time, in order: (batch_no, n_titles, titles joined by ``|``).

    Titles without an order are last, by title; repeated rows are asked for
    again. An empty table gives no batches.
    """
    rows = numbered(titles.select(F.col(order_col).alias("o"), F.col(title_col).alias("t")), F.col("o").asc_nulls_last(), F.col("t").asc_nulls_first())
    out = rows.select(F.floor(F.col("place") / size).cast("long").alias("batch_no"), F.col("place").alias("p"), "t")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "t"))), lambda x: x["t"]), "|")
    return out.groupBy("batch_no").agg(F.count("*").alias("n_titles"), joined.alias("titles"))
