"""Page filters and the directory of a page, as expressions: no shuffle, no join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.rules import java, strip


def title_reason(title: Column) -> Column:
    """Why a title is left out: first a prefix, then a word, then a pattern; null if it is kept."""
    out = F.lit(None).cast("string")
    checks = [(F.startswith(title, F.lit(p)), C.REASON_PREFIX + p) for p in C.SKIP_PREFIXES]
    checks += [(F.contains(title, F.lit(w)), C.REASON_WORD + w) for w in C.SKIP_TITLE_WORDS]
    checks += [(F.regexp_like(title, F.lit("(?i)" + java("|".join(f"(?:{p})" for p in C.SKIP_TITLE_PATTERNS)))), C.REASON_PATTERN)]
    for test, reason in reversed(checks):
        out = F.when(test, reason).otherwise(out)
    return out


def category_reason(categories: Column) -> Column:
    """The first category that holds a word of the list; null if none does."""
    words = F.lit(list(C.SKIP_CATEGORY_WORDS))
    return F.get(F.filter(categories, lambda c: F.exists(words, lambda w: F.contains(c, w))), F.lit(0))


def content_reason(wikitext: Column) -> Column:
    """Why a text is left out: it is empty or a redirect, or its first 500 characters hold a pattern."""
    pattern = "(?i)" + java("|".join(f"(?:{p})" for p in C.SKIP_CONTENT_PATTERNS))
    found = F.regexp_extract(F.substring(wikitext, 1, C.CONTENT_SAMPLE), pattern, 0)
    return (
        F.when(F.coalesce(wikitext, F.lit("")) == "", C.REASON_EMPTY)
        .when(F.startswith(wikitext, F.lit(C.REDIRECT)), C.REASON_REDIRECT)
        .when(found != "", F.concat(F.lit(C.REASON_CONTENT), found))
    )


def skip_reason(title: Column, categories: Column, wikitext: Column) -> Column:
    """The first reason of title, categories and text; null if the page is kept."""
    return F.coalesce(title_reason(title), F.concat(F.lit(C.REASON_CATEGORY), category_reason(categories)), content_reason(wikitext))


def is_redirect(wikitext: Column) -> Column:
    return F.coalesce(F.startswith(wikitext, F.lit(C.REDIRECT)), F.lit(False))


def redirect_target(wikitext: Column) -> Column:
    return F.when(is_redirect(wikitext), strip(F.substring(wikitext, F.lit(len(C.REDIRECT) + 1), F.length(wikitext))))


def tag_pages(pages: DataFrame) -> DataFrame:
    """``pages`` with skip_reason and status: pages that are left out stay, tagged ``skipped``."""
    out = pages.withColumn("skip_reason", skip_reason(F.col("title"), F.col("categories"), F.col("wikitext")))
    return out.withColumn("status", F.when(F.col("skip_reason").isNotNull(), "skipped").otherwise("completed"))


def without_redirects(pages: DataFrame) -> DataFrame:
    return pages.where("redirect_target IS NULL")


def directory_of(categories: Column, directories: tuple[tuple[str, str], ...] = C.DIRECTORIES) -> Column:
    """The directory of the first category that holds a word, its first such word; the categories' order counts first."""
    words = F.array(*(F.struct(F.lit(w).alias("word"), F.lit(d).alias("dir")) for w, d in directories))
    hits = F.flatten(F.transform(categories, lambda c: F.transform(F.filter(words, lambda k: F.contains(c, k["word"])), lambda k: k["dir"])))
    return F.coalesce(F.get(hits, F.lit(0)), F.lit(C.OTHER))


# ── look-ups in the page table ──────────────────────────────────────────────


def get_page(pages: DataFrame, title: str) -> DataFrame:
    return pages.where(F.col("title") == title)


def page_revision(pages: DataFrame, title: str) -> DataFrame:
    """One row: the revision of a page, 0 if there is none."""
    return get_page(pages, title).agg(F.coalesce(F.max("revision_id"), F.lit(0)).cast("long").alias("revision_id"))


def page_exists(pages: DataFrame, title: str) -> DataFrame:
    return get_page(pages, title).agg((F.count("*") > 0).alias("page_exists"))


def pages_by_status(pages: DataFrame, status: str) -> DataFrame:
    return pages.where(F.col("status") == status)


def distinct_titles(pages: DataFrame, title_col: str = "title") -> DataFrame:
    return pages.select(title_col).distinct()
