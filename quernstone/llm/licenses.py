"""Licence scans by canonical digest lookup (DataFrame operations only).

Texts are brought to a canonical form that differences of layout, case,
punctuation, copyright notices and spelling don't change; a whole text is a
known licence if the digest of its canonical form is that of the licence.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import let
from .common import LOWER, UPPER

#: Equivalent spellings of whole words, after lower-casing: fixed values (pattern, replacement), taken in this order.
#: Each word has a space on either side.
SPELLINGS = (
    (" (re|sub|un|)licenc(e|es|ed|ing|ee|ees|or|ors) ", " $1licens$2 "),
    (" sub  licens(e|es|ed|ing|able) ", " sublicens$1 "),
    (" (abridg|acknowledg|judg)ement(s|) ", " $1ment$2 "),
    (" (analog|catalog)ue(s|) ", " $1$2 "),
    (" (author|custom|emphas|initial|maxim|minim|organ|real|recogn|special|util)is(e|es|ed|er|ers|ing|ation|ations) ", " $1iz$2 "),
    (" analys(e|es|ed|ing) ", " analyz$1 "),
    (" artefact(s|) ", " artifact$1 "),
    (" (calib|cent)re(s|) ", " $1er$2 "),
    (" (cancel|label)l(ed|ing) ", " $1$2 "),
    (" copyright  holder(s|) ", " copyright  owner$1 "),
    (" (behavi|endeav|fav|hon)our(s|ed|ing|able|ably|) ", " $1or$2 "),
    (" fulfil(s|ment|) ", " fulfill$1 "),
    (" merchantib(le|ility) ", " merchantab$1 "),
    (" non  commercial(ly|) ", " noncommercial$1 "),
    (" percent ", " per  cent "),
    (" practis(e|es|ed|ing) ", " practic$1 "),
    (" programme(s|) ", " program$1 "),
    (" whilst ", " while "),
    (" wilful(ly|) ", " willful$1 "),
    (" https ", " http "),
)
#: What a text must hold for any of the spellings to occur: texts without are left as they are.
_ANY_SPELLING = f" (?:{'|'.join(a[1:] for a, _ in SPELLINGS)})"

#: What separates words besides ASCII (all of it but letters and digits), as first and last code points: punctuation,
#: symbols and spaces of Latin-1, the blocks of general, supplemental, CJK, small and full-width punctuation, of
#: currency, arrows, mathematics and shapes, trade marks, the replacement character and the private bullets of word
#: processors. Fixed values.
SEPARATORS = (
    *((0x80, 0xA9), (0xAB, 0xB1), (0xB4, 0xB4), (0xB6, 0xB8), (0xBB, 0xBB), (0xBF, 0xBF), (0xD7, 0xD7), (0xF7, 0xF7), (0x1680, 0x1680), (0x180E, 0x180E), (0x2000, 0x206F)),
    *((0x20A0, 0x20CF), (0x2117, 0x2117), (0x2120, 0x2120), (0x2122, 0x2122), (0x2190, 0x245F), (0x2500, 0x2BFF), (0x2E00, 0x2E7F), (0x3000, 0x3004), (0x3008, 0x3020)),
    *((0x3030, 0x3030), (0x30FB, 0x30FB), (0xF000, 0xF0FF), (0xFE10, 0xFE1F), (0xFE30, 0xFE6B), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65), (0xFFFD, 0xFFFD)),
)
_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACES = "\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
_HYPHENS = "\u2010\u2011\u2012\u2013\u2014\u2015\u2212\ufe58\ufe63\uff0d"
_BULLETS = "\xb7\u2022\u2023\u2043\u25aa\u25cf\u25e6\uf0b7"
_LINE_ENDS = "\x85\u2028\u2029"
#: No width and no meaning: soft hyphen, joiners, marks of direction and of byte order.
_INVISIBLE = "\xad\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"
#: Marks that are put into the text on the way: where a notice begins, where a paragraph ends, where a notice may end.
_BEGIN, _PARAGRAPH, _END = "\x02", "\x05", "\x06"
_MAPPED = UPPER + _SPACES + _BEGIN + _PARAGRAPH + _END + _HYPHENS + _BULLETS + _LINE_ENDS
#: Other separators than those become a bar, which stands for none of the marks that notices are told by.
_OTHERS = "".join(c for a, b in SEPARATORS for c in map(chr, range(a, b + 1)) if c not in _MAPPED + _INVISIBLE + "©")
_PLAIN = (
    _MAPPED + _OTHERS + _INVISIBLE,
    LOWER + " " * (len(_SPACES) + 3) + "-" * len(_HYPHENS) + "*" * len(_BULLETS) + "\n" * len(_LINE_ENDS) + "|" * len(_OTHERS),
)

#: What may lie between two words of a notice, a line's end and comment marks included.
_GAP = r"[\x09-\x0D #*/;:-]{1,20}"
#: A copyright mark: "copyright" before (c) or a year, or (c) before a year; years may be placeholders.
_YEAR = r"[\[<{(]?(?:(?:19|20)[0-9y]{2}|yyyy|year)"
_MARK = rf"copyright(?:{_GAP})?(?:\(c\)|{_YEAR})|\(c\)(?:{_GAP})?(?:copyright(?:{_GAP})?)?{_YEAR}"
#: Words that follow a notice: titles and first words of licences.
_OPENINGS = (
    "permission is hereby granted",
    "permission is granted",
    "permission to use",
    "redistribution and use",
    "this software is provided",
    "this is free and unencumbered software",
    "this program is free software",
    "this library is free software",
    "this program comes with",
    "gnomovision comes with",
    "everyone is permitted",
    "licensed under",
    "released under",
    "this work is licensed",
    "boost software license",
    "mit license",
    "mit licence",
    "the mit license",
    "the mit licence",
    "mit no attribution",
    "isc license",
    "isc licence",
    "bsd zero clause",
    "bsd 2-clause",
    "bsd 3-clause",
    "zlib license",
    "zlib licence",
)
_NEXT = "|".join(re.sub("[ -]", lambda _: _GAP, x) for x in _OPENINGS)
#: Texts without any of these have no notice.
_NOTICE_PARTS = ("copyright", "(c)", "reserved")
#: Steps (pattern, replacement) that take notices off a text in lower case that begins with a line's end. A notice with
#: its holder (160 characters of one paragraph at most) goes up to "all rights reserved", to an opening or to another
#: notice, wherever it stands; otherwise a whole line goes that has no more than the notice. Text behind a notice
#: stays. No look-around: Java and RE2 read the patterns alike.
NOTICE_STEPS = (
    (rf"([^a-z0-9])all{_GAP}rights{_GAP}reserved", f"$1{_END}"),
    (rf"([^a-z0-9])({_MARK})", f"$1{_END}{_BEGIN}$2"),
    (rf"([^a-z0-9])({_NEXT})", f"$1{_END}$2"),
    (r"\n[ \t\r#*/;-]*\n", f"\n{_PARAGRAPH}\n"),
    (r"\x02[^\x02\x05\x06]{0,160}?(\n?)[\x05\x09-\x0D #*/;-]{0,40}\x06", " $1"),
    (r"\n[ \t#*/;-]{0,40}\x06?\x02[^\n\x02\x05\x06]{0,160}(?:\n|\z)", "\n"),
)


def _any_of(text: Column, parts: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for x in parts:
        found = found | F.contains(text, F.lit(x))
    return found


def _without_notices(text: Column) -> Column:
    out = text
    for pattern, replacement in NOTICE_STEPS:
        out = F.regexp_replace(out, pattern, replacement)
    return F.when(_any_of(text, _NOTICE_PARTS), out).otherwise(text)


def _respelled(words: Column) -> Column:
    out = words
    for pattern, replacement in SPELLINGS:
        out = F.regexp_replace(out, pattern, replacement)
    return F.when(words.rlike(_ANY_SPELLING), out).otherwise(words)


def canonical(text: Column) -> Column:
    """The canonical form of a text; null for null, empty if it has no word outside notices.

    Words are separated before spellings are replaced, so a spelling of two words may be wrapped.
    """
    ascii_ = F.length(text) == F.octet_length(text)
    lower = F.when(ascii_ & ~_any_of(text, (_BEGIN, _PARAGRAPH, _END)), F.lower(text)).otherwise(F.replace(F.translate(text, *_PLAIN), F.lit("©"), F.lit("(c)")))
    plain = let(F.concat(F.lit("\n"), lower), _without_notices)
    words = F.regexp_replace(plain, _BETWEEN_WORDS, "  ")
    return F.trim(F.replace(let(F.concat(F.lit(" "), F.trim(words), F.lit(" ")), _respelled), F.lit("  "), F.lit(" ")))


#: Known digests that are sent to every executor, at 100 bytes each; more are joined by a shuffle.
BROADCAST_ROWS = 1 << 16


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_digests(spark: SparkSession, licenses: tuple[tuple[str, str], ...], digests: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """(license_id, digest) of licence texts and of given digests; the same digest under two ids keeps the first id."""
    rows = spark.createDataFrame(list(licenses), "license_id string, text string").select("license_id", digest(F.col("text")).alias("digest"))
    rows = rows.union(spark.createDataFrame(list(digests), "license_id string, digest string"))
    return rows.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_digest, license_id) for each row of ``docs``; license_id is null for other than known licences.

    A null text has no digest; a text without words is no licence. The join is
    on digests of whole texts; ``known`` may be of any size, and is broadcast
    only up to ``BROADCAST_ROWS`` rows.
    """
    few = known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    k = known.select(F.col("digest").alias("text_digest"), "license_id").where(F.col("text_digest") != F.sha2(F.lit("").cast("binary"), 256))
    return docs.select(F.col(id_col), digest(F.col(text_col)).alias("text_digest")).join(F.broadcast(k) if few else k, "text_digest", "left").select(id_col, "text_digest", "license_id")
