"""Regular-expression rules, applied in order by Spark's built-in functions.

A rule is (pattern, replacement); replacements refer to groups as ``\\1``. The
same table gives the Spark expression and the DuckDB text that tests and
oracles use. Patterns keep to what Java and RE2 read alike: line ends are line
feeds only, there are no back references and no look-around.
"""

from __future__ import annotations

import re
from functools import partial
from itertools import groupby
from os.path import commonprefix

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, str]


def java(pattern: str) -> str:
    """The pattern with line feeds as the only line ends, and Unicode white space where it asks for white space."""
    return ("(?dU)" if r"\s" in pattern else "(?d)") + pattern


def let(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def replace_all(col: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(col, F.lit(java(pattern)), F.lit(re.sub(r"\\(\d)", r"$\1", replacement.replace("$", r"\$"))))


def apply_rules(col: Column, rules: tuple[Rule, ...]) -> Column:
    for pattern, replacement in rules:
        col = replace_all(col, pattern, replacement)
    return col


def apply_needed(col: Column, rules: tuple[Rule, ...], needed: dict[Rule, str]) -> Column:
    """:func:`apply_rules`; a rule is left out for texts without the characters that all its matches hold, as ``needed`` says.

    Neighbours whose characters begin alike are asked for that beginning together: a text without it is looked through once.
    """

    def nest(text: Column, rules: tuple[Rule, ...], known: str) -> Column:
        for _, run in groupby(rules, lambda r: needed.get(r, "")[: len(known) + 1]):
            run = tuple(run)
            mark = commonprefix([needed.get(r, "") for r in run])
            text = apply_rules(text, run) if mark == known else let(text, partial(asked, run, mark))
        return text

    def asked(run: tuple[Rule, ...], mark: str, t: Column) -> Column:
        return F.when(F.contains(t, F.lit(mark)), nest(t, run, mark)).otherwise(t)

    return nest(col, rules, "")


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_replace(text: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({text}, {quote(pattern)}, {quote(replacement)}, 'g')"


def sql_rules(text: str, rules: tuple[Rule, ...]) -> str:
    for pattern, replacement in rules:
        text = sql_replace(text, pattern, replacement)
    return text


#: All white space of Unicode, which is what ``(?U)\\s`` matches; trimming looks at a text's ends only, a pattern at all of it.
SPACE = "\t\n\v\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(col: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(col, F.lit(SPACE))


def lstrip(col: Column) -> Column:
    return F.ltrim(col, F.lit(SPACE))


def rstrip(col: Column) -> Column:
    return F.rtrim(col, F.lit(SPACE))


#: White space for RE2, whose ``\\s`` is ASCII only.
SQL_SPACE = r"[\s\x{3000}\x{a0}]"


def sql_strip(text: str) -> str:
    return f"regexp_replace({text}, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')"


def sql_lstrip(text: str) -> str:
    return f"regexp_replace({text}, '^{SQL_SPACE}+', '')"


def sql_rstrip(text: str) -> str:
    return f"regexp_replace({text}, '{SQL_SPACE}+$', '')"
