"""The search index: entries, relevance, top-k, random picks, images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions import frontmatter as fm
from ..functions.rules import strip
from ..storage import materialize

SUMMARY_MARK = "简介"
DETAIL_SCORE = 20
ILLEGAL = r'[\\/:*?"<>|]'


def bucket_of(directory: Column) -> Column:
    return F.when(directory.isin(*C.OWN_BUCKET), directory).otherwise(C.OTHER)


def build_index(files: DataFrame) -> DataFrame:
    """Entries from files (directory, file_name, path, raw): only directories of the index count.

    dir_rank and file_name order equal scores. Front matter and preview come out
    of a generator: filters on them stay above it and compute neither again,
    filters on directories go below both.
    """
    dirs = F.lit(list(C.INDEX_DIRS))
    rows = files.where(F.col("directory").isin(*C.INDEX_DIRS) & F.endswith("file_name", F.lit(".md")))
    rows = rows.withColumn("parts", fm.split_file(F.col("raw"))).withColumn("front", fm.parse(F.col("parts.front")))
    rows = rows.select("directory", "path", "file_name", "parts", F.inline(F.array(F.struct("front", fm.preview(F.col("parts.body")).alias("preview")))))
    return rows.select(
        F.coalesce("front.title", F.regexp_replace("file_name", r"\.md\z", "")).alias("title"),
        F.col("path").alias("filepath"),
        F.coalesce("front.categories", F.array().cast("array<string>")).alias("categories"),
        "preview",
        bucket_of(F.col("directory")).alias("category_dir"),
        F.coalesce("front.image", F.lit("")).alias("image"),
        F.array_position(dirs, F.col("directory")).cast("int").alias("dir_rank"),
        "file_name",
        fm.content(F.col("parts.body")).alias("content"),
    )


def score(title: Column, categories: Column, preview: Column, query: str) -> Column:
    """Relevance of an entry for a query that is not blank; the first rule that fits counts."""
    q = query.lower().strip()
    lit, t = F.lit(q), F.lower(title)
    summary = F.contains(t, F.lit(SUMMARY_MARK))
    overlap = F.size(F.filter(F.lit(list(q)), lambda c: F.contains(t, c)))
    base = (
        F.when(t == lit, 100.0)
        .when(F.startswith(t, lit), 80.0 + F.when(summary, 10.0).otherwise(0.0))
        .when(F.contains(t, lit), 60.0 + F.lit(float(len(q))) / F.length(t) * 20.0 + F.when(summary, 5.0).otherwise(0.0))
        .when(F.exists(categories, lambda c: F.contains(F.lower(c), lit)), 30.0)
        .when(F.contains(F.lower(preview), lit), 15.0)
    )
    if len(q) >= 2:
        base = base.when(overlap >= len(q) * 0.6, 10.0 + overlap * 3.0)
    return F.greatest(base.otherwise(0.0) - F.when(F.length(preview) < 30, 40.0).otherwise(0.0), F.lit(0.0))


def search(index: DataFrame, query: str, bucket: str = "", limit: int = 5) -> DataFrame:
    """The best entries with score and rank: a filter and one top-k, no full sort. A blank query or unknown bucket finds nothing."""
    if not isinstance(index, DataFrame):
        return index.search(query, bucket, limit)
    if not query.strip() or (bucket and bucket not in C.BUCKETS):
        return index.limit(0).withColumns({"score": F.lit(0.0), "rank": F.lit(0)})
    rows = index.where(F.col("category_dir") == bucket) if bucket else index
    rows = rows.withColumn("score", score(F.col("title"), F.col("categories"), F.col("preview"), query)).where("score > 0")
    order = [F.desc("score"), "dir_rank", "file_name"]
    return rows.orderBy(*order).limit(limit).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def get_by_title(index: DataFrame, title: str, bucket: str = "") -> DataFrame:
    if not isinstance(index, DataFrame):
        return index.get_by_title(title, bucket)
    rows = index.where(F.col("category_dir") == bucket) if bucket else index
    return rows.where(F.lower("title") == title.lower().strip()).orderBy("dir_rank", "file_name").limit(1)


def random_pool(index: DataFrame, bucket: str) -> DataFrame:
    """The entries that a random pick draws from: those with over 50 characters of preview, else over 10, else all."""
    index, n = index if isinstance(index, DataFrame) else index.entries(), F.length("preview")
    rows = index.where(F.col("category_dir") == bucket).withColumn("tier", F.when(n > 50, 1).when(n > 10, 2).otherwise(3))
    least = rows.agg(F.min("tier").alias("least"))
    return rows.join(F.broadcast(least), F.col("tier") == F.col("least")).drop("least")  # one row is broadcast


def random_pick(index: DataFrame, bucket: str, seed: int | None = None) -> DataFrame:
    return random_pool(index, bucket).orderBy(F.rand(seed) if seed is not None else F.rand()).limit(1)


def bucket_counts(index: DataFrame) -> DataFrame:
    """Entries of each bucket, empty ones included."""
    names = index.sparkSession.createDataFrame([(b,) for b in C.BUCKETS], "category_dir string")
    counts = index.groupBy("category_dir").agg(F.count("*").alias("n"))
    return names.join(counts, "category_dir", "left").select("category_dir", F.coalesce("n", F.lit(0)).cast("long").alias("entries"))


def image_candidates(entries: DataFrame) -> DataFrame:
    """(title, category_dir, image_rank, candidate): where an entry's image may be, best first."""
    dirs = F.create_map(*(x for b, d in C.IMAGE_DIRS.items() for x in (F.lit(b), F.lit(list(d)))))
    names = F.when(F.contains("title", F.lit(" - ")), F.array(F.col("title"), F.substring_index("title", " - ", 1))).otherwise(F.array("title"))
    paths = F.flatten(
        F.transform(
            F.coalesce(F.try_element_at(dirs, F.col("category_dir")), F.array().cast("array<string>")),
            lambda d: F.flatten(F.transform(names, lambda n: F.transform(F.lit(list(C.IMAGE_EXTENSIONS)), lambda e: F.concat(d, F.lit("/"), F.regexp_replace(n, F.lit(ILLEGAL), F.lit("_")), e)))),
        )
    )
    return entries.select("title", "category_dir", F.posexplode(paths).alias("image_rank", "candidate"))


def resolve_images(entries: DataFrame, images: DataFrame) -> DataFrame:
    """(title, category_dir, image): the first candidate in ``images`` (path), empty if none is there."""
    listed = images.select(F.col("path").alias("candidate")).distinct()
    keys = materialize(entries.select("title", "category_dir").distinct(), "keys")
    best = image_candidates(keys).join(listed, "candidate")
    best = best.groupBy("title", "category_dir").agg(F.min_by("candidate", "image_rank").alias("image"))
    return keys.join(best, ["title", "category_dir"], "left").withColumn("image", F.coalesce("image", F.lit("")))


def actor_names(pages: DataFrame) -> DataFrame:
    """Voice actors named by categories, at least two characters long, sorted."""
    c = pages.select(F.explode("categories").alias("c")).where(F.contains("c", F.lit(C.ACTOR_MARK)))
    name = strip(F.replace(F.col("c"), F.lit(C.ACTOR_MARK), F.lit("")))
    return c.select(name.alias("actor")).where(F.length("actor") >= 2).distinct().orderBy("actor")


def empty_index(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "title string, filepath string, categories array<string>, preview string, category_dir string, image string, dir_rank int, file_name string, content string")
