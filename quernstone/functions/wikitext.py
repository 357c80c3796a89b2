"""Wiki markup to Markdown, and long pages to sections, as Catalyst expressions.

``strict`` keeps the established results, oddities included; ``strict=False``
repairs three of them: bold text at a line's start is not taken for a list,
nested lists keep their indentation and definition lists are recognised.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import REDIRECT
from .rules import Rule, apply_needed, apply_rules, java, let, lstrip, quote, replace_all, rstrip, sql_lstrip, sql_replace, sql_rstrip, sql_rules, sql_strip, strip

# The patterns of the markup.
COMMENT = (r"(?s)<!--.*?-->", "")
REF_PAIR = (r"(?s)<ref[^>]*>.*?</ref>", "")
REF_SINGLE = (r"<ref[^/]*/>", "")
CATEGORY_LINK = (r"(?i)\[\[Category:[^\]]*\]\]", "")
FILE_LINK = (r"(?i)\[\[(File|文件|Image|Media):[^\]]*\]\]", "")
INVOKE = (r"(?i)\{\{#invoke:[^}]*\}\}", "")
TEMPLATE = (r"\{\{[^}]*\}\}", "")
TABLE = (r"(?s)\{\|.*?\|\}", "")
ATTRIBUTE = (r"\|[a-zA-Z_]+\s*=\s*", "")
HTML_TAG = (r"</?[^>]+>", "")
BOLD = (r"'''(.+?)'''", r"**\1**")
ITALIC = (r"''(.+?)''", r"*\1*")
NAMESPACE_LINK = (r"(?i)\[\[(category:|file:|文件:|image:|template:|module:|help:|special:)[^\]|]*(\|[^\]]+)?\]\]", "")
PIPED_LINK = (r"\[\[([^\]|]+)\|([^\]]+)\]\]", r"\2")
PLAIN_LINK = (r"\[\[([^\]|]+)\]\]", r"\1")
BARE_URL_LINK = (r"\[(https?://[^\s\]]+)\s+\]", r"[\1](\1)")
URL_LINK = (r"\[(https?://[^\s\]]+)\s+([^\]]*)\]", r"[\2](\1)")
RULER = (r"(?m)^-{4,}$", "---")
#: Marks around term and definition, so that white space at their ends can go; a text's own marks are kept apart by ``free_of_marks``.
_TERM, _TERM_END, _MEANING_END = "\x02", "\x03", "\x04"
DEFINITIONS = (
    (r"(?m)^;(.+?):\s*(.+)$", rf"{_TERM}\1{_TERM_END}\2{_MEANING_END}"),
    (rf"{_TERM}\s*", "**"),
    (rf"\s*{_TERM_END}\s*", "**: "),
    (rf"\s*{_MEANING_END}", ""),
)
BLANK_LINES = (r"\n{3,}", "\n\n")
LEADING_BLANKS = (r"(?m)^[ \t]+", "")
EMPTY_ITEM = (r"(?m)^\s*[-*]\s*$", "")
LIST_ITEM = r"^([*#;:]+)\s*(.+)$"

UNWANTED: tuple[Rule, ...] = (COMMENT, REF_PAIR, REF_SINGLE, CATEGORY_LINK, FILE_LINK, INVOKE, TEMPLATE, TABLE, ATTRIBUTE, HTML_TAG)
EMPHASIS: tuple[Rule, ...] = (BOLD, ITALIC)
LINKS: tuple[Rule, ...] = (NAMESPACE_LINK, PIPED_LINK, PLAIN_LINK, BARE_URL_LINK, URL_LINK)
#: Headings have one rule for each level, the deepest first; beyond these levels rules are made for the levels that a text has.
HEADING_LEVELS = 9
HEADINGS: tuple[Rule, ...] = tuple((rf"(?m)^={{{n}}}\s*(.+?)\s*={{{n}}}\s*$", rf"\n\n{'#' * n} \1\n\n".replace(r"\n", "\n")) for n in range(HEADING_LEVELS, 0, -1))
#: What every match of a rule holds: most lines of a page have no markup, and to look for a word costs little.
NEEDED: dict[Rule, str] = (
    {COMMENT: "<!--", REF_PAIR: "<ref", REF_SINGLE: "<ref", INVOKE: "{{#", TEMPLATE: "{{", TABLE: "{|", ATTRIBUTE: "|", HTML_TAG: "<", BOLD: "'''", ITALIC: "''", RULER: "----", BLANK_LINES: "\n\n\n"}
    | dict.fromkeys((CATEGORY_LINK, FILE_LINK, NAMESPACE_LINK, PIPED_LINK, PLAIN_LINK), "[[") | dict.fromkeys((BARE_URL_LINK, URL_LINK), "[http")
    | {DEFINITIONS[0]: ";"} | {rule: "=" * n for rule, n in zip(HEADINGS, range(HEADING_LEVELS, 0, -1), strict=True)}
)


#: The marks of definitions and sections, and the sign that stands before the digit of an escaped one.
_MARKS, _ESCAPE = "\x01\x02\x03\x04", "\x05"
_ESCAPED = tuple((mark, f"{_ESCAPE}{digit}") for digit, mark in enumerate(_ESCAPE + _MARKS))


def free_of_marks(text: Column, work: Callable[[Column], Column], back: Callable[[Column, Callable[[Column], Column]], Column] = lambda made, plain: plain(made)) -> Column:
    """``work`` done on ``text`` whose own mark characters are escaped meanwhile; ``back`` undoes the escapes in what comes out.

    Texts without such characters, nearly all, are worked on as they are.
    """

    def escape(t: Column) -> Column:
        for mark, written in _ESCAPED:
            t = F.replace(t, F.lit(mark), F.lit(written))
        return t

    def plain(t: Column) -> Column:
        for mark, written in reversed(_ESCAPED):
            t = F.replace(t, F.lit(written), F.lit(mark))
        return t

    return let(text, lambda t: F.when(F.regexp_like(t, F.lit(r"[\x01-\x05]")), back(work(escape(t)), plain)).otherwise(work(t)))


def remove_unwanted(text: Column) -> Column:
    return apply_needed(text, UNWANTED, NEEDED)


def convert_emphasis(text: Column) -> Column:
    return apply_needed(text, EMPHASIS, NEEDED)


def convert_links(text: Column) -> Column:
    return apply_needed(text, LINKS, NEEDED)


def convert_lists(text: Column, strict: bool = True) -> Column:
    """Lines that begin with ``*``, ``#``, ``;`` or ``:`` become list items or bare text."""
    item = java(LIST_ITEM)

    def line(raw: Column) -> Column:
        own = lstrip(raw)
        marks = F.regexp_extract(own, item, 1)
        indent = F.repeat(F.lit("  "), F.length(marks) - 1)
        sign = F.when(F.contains(marks, F.lit("#")), "1. ").when(F.contains(marks, F.lit("*")), "- ").otherwise("")
        fits = F.substring(own, 1, 1).isin(*"*#;:") & F.regexp_like(own, F.lit(item))
        if not strict:
            fits = fits & ~F.regexp_like(own, F.lit(r"^(\*\*[^*\s]|\*[^*\s]+\*|;.+:)"))
        return F.when(fits, F.concat(indent, sign, strip(F.regexp_extract(own, item, 2)))).otherwise(raw)

    return F.array_join(F.transform(F.split(text, "\n", -1), line), "\n")


def convert_headings(text: Column) -> Column:
    """Headings of any level."""

    def deeper(t: Column) -> Column:
        longest = F.array_max(F.transform(F.regexp_extract_all(t, F.lit("=+"), F.lit(0)), F.length))

        def one(x: Column, n: Column) -> Column:
            marks = F.concat(F.lit("={"), n.cast("string"), F.lit("}"))
            pattern = F.concat(F.lit("(?dUm)^"), marks, F.lit(r"\s*(.+?)\s*"), marks, F.lit(r"\s*$"))
            return F.regexp_replace(x, pattern, F.concat(F.lit("\n\n"), F.repeat(F.lit("#"), n), F.lit(" $1\n\n")))

        return F.aggregate(F.sequence(longest, F.lit(HEADING_LEVELS + 1), F.lit(-1)), t, one)

    deep = let(text, lambda t: F.when(F.contains(t, F.lit("=" * (HEADING_LEVELS + 1))), deeper(t)).otherwise(t))
    return apply_needed(deep, HEADINGS, NEEDED)


def convert_rulers(text: Column) -> Column:
    return apply_needed(text, (RULER,), NEEDED)


def convert_definitions(text: Column) -> Column:
    """``;term : definition`` lines. Marks and the white space at them are on one line, so only lines with a mark are looked at again."""

    def line(one: Column) -> Column:
        return F.when(F.contains(one, F.lit(_TERM)), apply_rules(one, DEFINITIONS[1:])).otherwise(one)

    def work(t: Column) -> Column:
        return let(apply_needed(t, DEFINITIONS[:1], NEEDED), lambda m: F.when(F.contains(m, F.lit(_TERM)), F.array_join(F.transform(F.split(m, "\n", -1), line), "\n")).otherwise(m))

    return free_of_marks(text, work)


def _rstrip_lines(text: Column) -> Column:
    return F.array_join(F.transform(F.split(text, "\n", -1), rstrip), "\n")


def tidy(text: Column, strict: bool = True) -> Column:
    """Collapse blank lines, drop leading blanks, empty items and blanks at line ends."""
    text = apply_needed(text, (BLANK_LINES, LEADING_BLANKS, EMPTY_ITEM) if strict else (BLANK_LINES, EMPTY_ITEM), NEEDED)
    return let(_rstrip_lines(text), lambda t: F.when(F.endswith(t, F.lit("\n")), strip(t)).otherwise(lstrip(t)))  # lines end without blanks


def parse_markdown(wikitext: Column, strict: bool = True) -> Column:
    """The Markdown of a page; empty for an empty or null page and for a redirect."""
    text = convert_links(convert_emphasis(remove_unwanted(wikitext)))
    text = convert_definitions(convert_rulers(convert_headings(convert_lists(text, strict))))
    return F.when(wikitext.isNull() | (wikitext == "") | F.startswith(wikitext, F.lit(REDIRECT)), "").otherwise(tidy(text, strict))


#: The plain clean-up: plain links vanish, piped ones leave their text.
FALLBACK: tuple[Rule, ...] = (COMMENT, REF_PAIR, REF_SINGLE, CATEGORY_LINK, FILE_LINK, TEMPLATE, TABLE, HTML_TAG, PIPED_LINK, (PLAIN_LINK[0], ""), *EMPHASIS, *HEADINGS, BLANK_LINES)


def fallback_clean(text: Column) -> Column:
    return strip(apply_needed(text, FALLBACK, NEEDED))


# ── sections ────────────────────────────────────────────────────────────────

_MARK = "\x01"


def split_by_heading(markdown: Column, level: int) -> Column:
    """Sections as an array of (heading, text); text before the first heading has a null heading."""
    return let(markdown, lambda md: _sections(md, level))


_SECTIONS = "array<struct<heading:string,text:string>>"


def _sections(markdown: Column, level: int) -> Column:
    sign, none = "#" * level + " ", F.lit(None).cast("string")

    def section(part: Column) -> Column:
        head = F.substring_index(part, "\n", 1)
        return let(F.struct(strip(head).alias("h"), strip(F.substring(part, F.length(head) + 1, F.length(part))).alias("b")), titled)

    def titled(x: Column) -> Column:
        text = F.when(x["b"] != "", F.concat(x["h"], F.lit("\n\n"), x["b"])).otherwise(x["h"])
        return F.struct(F.regexp_replace(x["h"], F.lit(r"(?U)^#+\s*"), F.lit("")).alias("heading"), text.alias("text"))

    def all_of(parts: Column) -> Column:
        first = F.filter(F.array(F.struct(none.alias("heading"), strip(F.get(parts, F.lit(0))).alias("text"))), lambda x: x["text"] != "")
        return F.concat(first, F.transform(F.slice(parts, F.lit(2), F.size(parts)), section))

    parts = free_of_marks(markdown, lambda md: F.split(replace_all(md, rf"(?m)^({sign}.+)$", _MARK + r"\1"), _MARK, -1), F.transform)
    whole = F.array(F.struct(none.alias("heading"), markdown.alias("text")))
    return let(let(parts, all_of), lambda found: F.when(F.size(found) > 0, found).otherwise(whole)).cast(_SECTIONS)


def split_long_pages(pages: DataFrame, threshold: int = 5000, title_col: str = "display_title", markdown_col: str = "markdown", skip_empty: bool = False) -> DataFrame:
    """A row for each chunk of each page: all columns, and chunk_no, n_chunks, chunk_title, chunk_markdown, section_level.

    Long pages are split at level-2 headings, else at level 3; text before the
    first heading joins the first section; sections half as long again as the
    threshold are split at level 3. The sections are one array expression per
    page with one generator: no shuffle. ``skip_empty`` leaves pages without
    text out, here rather than by a filter, which would parse them once more.
    """
    title = F.col(title_col)
    tail = "_" * (1 + max(map(len, pages.columns)))
    place, chunk = f"place{tail}", f"chunk{tail}"

    def chunk_of(t: Column, text: Column, level: int) -> Column:
        return F.struct(t.alias("title"), text.alias("text"), F.lit(level).alias("level"))

    def cut(section: Column, i: Column) -> Column:
        plain = F.array(chunk_of(F.concat(title, F.lit(" - "), section["heading"]), section["text"], 2))
        number = F.concat(F.lit(" ("), (i + 1).cast("string"), F.lit("-"))

        def deep(subs: Column) -> Column:
            below = F.transform(subs, lambda x, j: chunk_of(F.coalesce(F.concat(title, F.lit(" - "), x["heading"]), F.concat(title, number, (j + 1).cast("string"), F.lit(")"))), x["text"], 3))
            return F.when(F.size(subs) > 1, below).otherwise(plain)

        return F.when(F.length(section["text"]) > threshold * 1.5, let(split_by_heading(section["text"], 3), deep)).otherwise(plain)

    def merged(s: Column) -> Column:
        first, following = F.get(s, F.lit(0)), F.get(s, F.lit(1))
        joined = F.array(F.struct(following["heading"].alias("heading"), F.concat(first["text"], F.lit("\n\n"), following["text"]).alias("text")))
        return F.when(first["heading"].isNull(), F.concat(joined, F.slice(s, F.lit(3), F.size(s)))).otherwise(s)

    def chunks_of(md: Column) -> Column:
        whole = F.array(chunk_of(title, md, 2))

        def from_sections(s: Column) -> Column:
            return F.when(F.size(s) > 1, F.flatten(F.transform(merged(s), cut))).otherwise(whole)

        sections = let(split_by_heading(md, 2), lambda s: F.when(F.size(s) > 1, s).otherwise(split_by_heading(md, 3)))
        found = F.when(F.length(md) > threshold, let(sections, from_sections)).otherwise(whole)
        return F.filter(found, lambda _: F.trim(md) != "") if skip_empty else found

    out = pages.withColumn(chunk, let(F.col(markdown_col), chunks_of))
    out = out.select(*pages.columns, F.posexplode(F.transform(chunk, lambda c: F.struct(c.alias("c"), F.size(chunk).cast("long").alias("n")))).alias(place, chunk))
    return out.select(
        *pages.columns, (F.col(place) + 1).cast("long").alias("chunk_no"), F.col(f"{chunk}.n").alias("n_chunks"),
        F.col(f"{chunk}.c.title").alias("chunk_title"), F.col(f"{chunk}.c.text").alias("chunk_markdown"), F.col(f"{chunk}.c.level").cast("long").alias("section_level"),
    )


# ── the same in DuckDB's SQL, for oracles ───────────────────────────────────


def sql_lists(text: str) -> str:
    own = sql_lstrip("l")
    marks = f"regexp_extract({own}, {quote(LIST_ITEM)}, 1)"
    sign = f"CASE WHEN contains({marks}, '#') THEN '1. ' WHEN contains({marks}, '*') THEN '- ' ELSE '' END"
    content = sql_strip(f"regexp_extract({own}, {quote(LIST_ITEM)}, 2)")
    item = f"CASE WHEN regexp_matches({own}, {quote(LIST_ITEM)}) THEN repeat('  ', length({marks}) - 1) || {sign} || {content} ELSE l END"
    return f"array_to_string(list_transform(string_split({text}, chr(10)), lambda l: {item}), chr(10))"


def sql_markdown(text: str) -> str:
    out = sql_rules(text, UNWANTED + EMPHASIS + LINKS)
    out = sql_rules(sql_lists(out), (*HEADINGS, RULER, *DEFINITIONS, BLANK_LINES, LEADING_BLANKS, EMPTY_ITEM))
    out = f"array_to_string(list_transform(string_split({out}, chr(10)), lambda l: {sql_rstrip('l')}), chr(10))"
    return f"CASE WHEN {text} IS NULL OR {text} = '' OR starts_with({text}, '{REDIRECT}') THEN '' ELSE {sql_strip(out)} END"


def sql_fallback(text: str) -> str:
    return sql_strip(sql_rules(text, FALLBACK))


def sql_sections(text: str, level: int) -> str:
    """An array of structs (heading, text) like :func:`split_by_heading`."""
    parts = f"string_split({sql_replace(text, f'(?m)^({"#" * level} .+)$', _MARK + chr(92) + '1')}, chr(1))"
    head = sql_strip("string_split(p, chr(10))[1]")
    body = sql_strip("substr(p, length(string_split(p, chr(10))[1]) + 1)")
    section = f"{{'heading': regexp_replace({head}, '^#+\\s*', ''), 'text': CASE WHEN {body} <> '' THEN {head} || chr(10) || chr(10) || {body} ELSE {head} END}}"
    first = sql_strip(f"({parts})[1]")
    before = f"CASE WHEN {first} <> '' THEN [{{'heading': NULL::VARCHAR, 'text': {first}}}] ELSE [] END"
    found = f"list_concat({before}, list_transform(({parts})[2:], lambda p: {section}))"
    return f"CASE WHEN len({found}) > 0 THEN {found} ELSE [{{'heading': NULL::VARCHAR, 'text': {text}}}] END"


