"""Front matter and bodies of Markdown files."""

from __future__ import annotations

import datetime

import pandas as pd
import yaml
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rules import SPACE, apply_rules, let, lstrip, replace_all, strip

PREVIEW_CHARS, CONTENT_CHARS = 200, 1500
#: Types are objects, not text: executors import this module without a session.
FIELDS = T.StructType(
    [T.StructField(n, T.LongType() if n == "revision" else T.ArrayType(T.StringType()) if n == "categories" else T.StringType()) for n in ("title", "url", "revision", "updated", "categories", "image")]
)


@F.pandas_udf(T.StringType())
def _dump(rows: pd.DataFrame) -> pd.Series:
    def one(title, url, revision, updated, categories):
        data = {"title": title, "url": url}
        if revision is not None and revision == revision and revision:
            data["revision"] = int(revision)
        if isinstance(updated, str) and updated:
            data["updated"] = updated
        if categories is not None and len(categories):
            data["categories"] = list(categories)
        return yaml.dump(data, allow_unicode=True, default_flow_style=False, sort_keys=False)

    return pd.Series([one(*r) for r in rows[["title", "url", "revision", "updated", "categories"]].itertuples(index=False)], dtype=object)


def dump(title: Column, url: Column, revision: Column, updated: Column, categories: Column) -> Column:
    """Front matter as YAML writes it (quotes and folding included), in this order of keys; empty values are left out."""
    return _dump(F.struct(title.alias("title"), url.alias("url"), revision.alias("revision"), updated.alias("updated"), categories.alias("categories")))


def dump_plain(title: Column, url: Column, revision: Column, updated: Column, categories: Column) -> Column:
    """The same for values that YAML writes unquoted on one line, without leaving the JVM; dates are quoted."""

    def line(key: str, value: Column, on: Column) -> Column:
        return F.when(on, F.concat(F.lit(f"{key}: "), value, F.lit("\n"))).otherwise("")

    cats = F.when(F.size(categories) > 0, F.concat(F.lit("categories:\n"), F.array_join(F.transform(categories, lambda c: F.concat(F.lit("- "), c, F.lit("\n"))), ""))).otherwise("")
    return F.concat(
        line("title", title, title.isNotNull()), line("url", url, url.isNotNull()),
        line("revision", revision.cast("string"), F.coalesce(revision, F.lit(0)) != 0),
        line("updated", F.concat(F.lit("'"), updated, F.lit("'")), F.coalesce(updated, F.lit("")) != ""), cats,
    )


def split_file(raw: Column) -> Column:
    """(front, body, has) of a file's text; without front matter the body is all of it."""

    def of(parts: Column) -> Column:
        has = F.startswith(raw, F.lit("---")) & (F.size(parts) >= 3)
        return F.struct(F.when(has, F.get(parts, F.lit(1))).alias("front"), F.when(has, F.get(parts, F.lit(2))).otherwise(raw).alias("body"), has.alias("has"))

    return let(F.split(raw, "---", 3), of)


def _text(value) -> str | None:
    if value is None or value == "":
        return None
    return value if isinstance(value, str) else value.isoformat() if isinstance(value, datetime.date) else str(value)


#: The safe loader in C, where it is there.
_LOADER = getattr(yaml, "CSafeLoader", yaml.SafeLoader)


@F.pandas_udf(FIELDS)
def parse(front: pd.Series) -> pd.DataFrame:
    """Front matter as a struct; all null if it is missing, broken or no mapping. Categories count only as a list."""
    rows = []
    for text in front:
        try:
            data = yaml.load(text, Loader=_LOADER) if isinstance(text, str) else None
        except yaml.YAMLError:
            data = None
        data = data if isinstance(data, dict) else {}
        cats = data.get("categories")
        revision = data.get("revision")
        rows.append((_text(data.get("title")), _text(data.get("url")), revision if isinstance(revision, int) else None, _text(data.get("updated")), [str(c) for c in cats if c] if isinstance(cats, list) else None, _text(data.get("image"))))
    out = pd.DataFrame(rows, columns=["title", "url", "revision", "updated", "categories", "image"], dtype=object)
    out["revision"] = out["revision"].astype("Int64")
    return out


def preview(body: Column, chars: int = PREVIEW_CHARS) -> Column:
    """The first characters of a body without its first heading line, blank lines and heading marks.

    Made from the body's beginning where that gives enough: it gives what the whole body gives, but for blanks and heading
    marks at its end, which what follows may change, and a heading line that doesn't end in it.
    """

    def plain(text: Column) -> Column:
        return apply_rules(F.regexp_replace(text, F.lit(r"(?d)\A#.*\n"), F.lit("")), ((r"\n{2,}", " "), (r"#+\s", "")))

    def of(head: Column) -> Column:
        whole_line = ~F.startswith(head, F.lit("#")) | F.contains(head, F.lit("\n"))
        enough = lambda made: whole_line & (F.length(made) >= chars)
        return let(F.rtrim(plain(head), F.lit("#" + SPACE)), lambda made: strip(F.substring(F.when(enough(made), made).otherwise(plain(strip(body))), 1, chars)))

    return let(F.substring(lstrip(body), 1, chars * 8), of)


def content(body: Column, chars: int = CONTENT_CHARS) -> Column:
    """The first characters of a body; only one whose beginning ends in a blank is looked at as a whole, as blanks at its own end don't count."""
    return let(F.substring(lstrip(body), 1, chars), lambda head: F.when(strip(F.substring(head, -1, 1)) == "", F.substring(strip(body), 1, chars)).otherwise(head))


def clean(text: Column) -> Column:
    """A body for display: no headings, asterisks, hard spaces or runs of blank lines."""
    out = replace_all(text, r"#{1,4}\s+[^\n]+\n?", "")
    out = F.replace(out, F.lit("&nbsp;"), F.lit(" "))
    return strip(apply_rules(out, ((r"\*{1,3}", ""), (r"\n{3,}", "\n\n"))))


def short_preview(text: Column, chars: int = 120) -> Column:
    return strip(F.replace(F.substring(clean(text), 1, chars), F.lit("\n"), F.lit(" ")))


# ── DuckDB ──────────────────────────────────────────────────────────────────


def sql_clean(text: str) -> str:
    from .rules import sql_replace, sql_rules, sql_strip

    out = f"replace({sql_replace(text, chr(35) + '{1,4}' + chr(92) + 's+[^\\n]+\\n?', '')}, '&nbsp;', ' ')"
    return sql_strip(sql_rules(out, ((r"\*{1,3}", ""), (r"\n{3,}", "\n\n"))))
