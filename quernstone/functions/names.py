"""Titles, file names, URLs and other short texts."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BASE_URL
from .rules import strip

# Fixed values.
ILLEGAL_CHARS = r'[\\/:*?"<>|\x00-\x1f]'
DISPLAY_PREFIXES = ("Category:", "Template:", "Module:", "Help:")
STRIP_PREFIXES = ("Category:", "Template:", "Module:", "Help:", "File:")
MOST_NAME = 200


@F.pandas_udf(T.StringType())
def _nfc(names: pd.Series) -> pd.Series:
    return names.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def nfc(col: Column) -> Column:
    """Unicode normal form C; there is no built-in function for it, so an Arrow-batched one."""
    return _nfc(col)


def sanitize_filename(name: Column, most: int = MOST_NAME, normalize: bool = True) -> Column:
    """A file name for a title: no characters that file systems refuse, one ``_`` for runs of space, no end dots.

    ``normalize=False`` is for names that are in normal form C already: all of it stays in the JVM.
    """
    out = nfc(name) if normalize else name
    out = F.regexp_replace(out, F.lit(ILLEGAL_CHARS), F.lit("_"))
    out = F.regexp_replace(out, F.lit(r"(?U)[\s_]+"), F.lit("_"))
    out = F.btrim(out, F.lit(" _"))
    out = F.regexp_replace(out, F.lit(r"[. ]+\z"), F.lit(""))
    out = F.when(F.length(out) > most, F.regexp_replace(F.substring(out, 1, most), F.lit(r"[ _.]+\z"), F.lit(""))).otherwise(out)
    return F.when(out == "", "unnamed").otherwise(out)


def sql_sanitize(name: str, most: int = MOST_NAME) -> str:
    out = f"regexp_replace(nfc_normalize({name}), '{ILLEGAL_CHARS}', '_', 'g')"
    out = f"regexp_replace({out}, '[\\s_\\x{{3000}}\\x{{a0}}]+', '_', 'g')"
    out = f"regexp_replace(trim({out}, ' _'), '[. ]+$', '')"
    out = f"CASE WHEN length({out}) > {most} THEN regexp_replace(substr({out}, 1, {most}), '[ _.]+$', '') ELSE {out} END"
    return f"coalesce(nullif({out}, ''), CASE WHEN {name} IS NOT NULL THEN 'unnamed' END)"


def display_title(title: Column) -> Column:
    """Without each of four prefixes, taken in turn."""
    for p in DISPLAY_PREFIXES:
        title = F.regexp_replace(title, F.lit(f"^{p}"), F.lit(""))
    return title


def sql_display_title(title: str) -> str:
    for p in DISPLAY_PREFIXES:
        title = f"regexp_replace({title}, '^{p}', '')"
    return title


def strip_namespace(title: Column) -> Column:
    """Without the first of five prefixes, once."""
    return F.regexp_replace(title, F.lit(f"^({'|'.join(STRIP_PREFIXES)})"), F.lit(""))


def normalize_category(title: Column) -> Column:
    return F.when(F.startswith(title, F.lit("Category:")), title).otherwise(F.concat(F.lit("Category:"), title))


def percent_encode(text: Column) -> Column:
    """Everything but letters, digits and ``_.-~`` percent-encoded."""
    out = F.url_encode(text)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def percent_decode(text: Column) -> Column:
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def page_url(title: Column, base: str = BASE_URL) -> Column:
    return F.concat(F.lit(base + "/"), percent_encode(title))


def category_url(category: Column, pagefrom: Column | None = None, base: str = BASE_URL) -> Column:
    """The address of a category's listing; slashes in ``pagefrom`` stay."""
    out = F.concat(F.lit(base + "/"), F.replace(category, F.lit(" "), F.lit("_")))
    if pagefrom is None:
        return out
    return F.when(F.coalesce(pagefrom, F.lit("")) == "", out).otherwise(F.concat(out, F.lit("?pagefrom="), F.replace(percent_encode(pagefrom), F.lit("%2F"), F.lit("/"))))


def url_to_title(url: Column) -> Column:
    return percent_decode(F.substring_index(url, "/", -1))


def before_dash(title: Column) -> Column:
    return F.substring_index(title, " - ", 1)


def char_count(text: Column) -> Column:
    return F.length(text).cast("long")


def truncate(text: Column, most: int = 100) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 3), F.lit("..."))).otherwise(text)


def output_path(title: Column, directory: Column, root: str, suffix: Column | None = None, normalize: bool = True) -> Column:
    return named_path(sanitize_filename(title, normalize=normalize), directory, root, suffix)


def named_path(name: Column, directory: Column, root: str, suffix: Column | None = None) -> Column:
    """The path of a file whose ``name`` :func:`sanitize_filename` has given."""
    return F.concat(F.lit(root + "/"), directory, F.lit("/"), name if suffix is None else F.concat(name, suffix), F.lit(".md"))


def short_date(updated: Column) -> Column:
    """A timestamp or text as yyyy-MM-dd; null if it is missing or empty."""
    text = F.coalesce(F.date_format(F.try_to_timestamp(updated.cast("string")), "yyyy-MM-dd"), F.substring(updated.cast("string"), 1, 10))
    return F.nullif(text, F.lit(""))


def command_argument(message: Column, command: str) -> Column:
    """What follows a command in a message: one slash and the command are dropped."""
    out = F.regexp_replace(strip(message), F.lit("^/"), F.lit(""))
    return strip(F.when(F.startswith(out, F.lit(command)), F.substring(out, F.lit(len(command) + 1), F.length(out))).otherwise(out))
