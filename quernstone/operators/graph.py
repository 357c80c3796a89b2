"""Discovery of pages in a category graph, breadth first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize


def discover(edges: DataFrame, root: str, max_depth: int = 10) -> DataFrame:
    """(title, depth, page_type) of all pages and categories that ``root`` reaches.

    ``edges`` has (parent, title, page_type); page_type is ``subcat`` or
    ``page``. The depth of a category is its distance from the root, that of a
    page the least depth of a category that lists it. Categories deeper than
    ``max_depth`` are reached but not expanded. Each level is one join of the
    categories that are new with the edges; what was visited is taken off by
    an anti-join, so cycles end. Levels are written to shared storage, which
    keeps plans short and survives lost executors.
    """
    spark = edges.sparkSession
    sub = edges.where("page_type = 'subcat'").select("parent", "title")
    visited = level = spark.createDataFrame([(root, 0)], "title string, depth int")
    for depth in range(max_depth + 1):
        found = sub.join(level.select(F.col("title").alias("parent")), "parent").select("title").distinct()
        level = materialize(found.join(visited.select("title"), "title", "left_anti").withColumn("depth", F.lit(depth + 1)), f"level{depth}")
        if level.isEmpty():
            break
        visited = visited.unionByName(level)
    expanded = visited.where(F.col("depth") <= max_depth)
    pages = edges.where("page_type = 'page'").join(expanded.withColumnRenamed("title", "parent"), "parent")
    pages = pages.groupBy("title").agg(F.min("depth").alias("depth")).withColumn("page_type", F.lit("page"))
    return visited.withColumn("page_type", F.lit("subcat")).unionByName(pages)


def uncrawled(categories: DataFrame) -> DataFrame:
    """Categories that were not crawled, by depth and title."""
    return categories.where(~F.col("crawled")).orderBy("depth", "title")


def first_seen(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key in the given order; an aggregate, so a hot key is combined before the shuffle."""
    best = rows.groupBy(key).agg(F.min(F.struct(*order, *(c for c in rows.columns if c not in order))).alias("row"))
    return best.select(*(F.col(f"row.{c}").alias(c) for c in rows.columns))
