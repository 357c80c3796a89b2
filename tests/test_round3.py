"""Findings of round 3: what is made of a file's beginning alone, what is asked of a text once, what is read once."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from quernstone import queries, queries_io, services
from quernstone.functions import frontmatter as fm
from quernstone.functions import wikitext as w
from quernstone.functions.rules import apply_rules, strip


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bodies():
    """Bodies whose blanks, line ends and heading marks fall around every cut."""
    rng = random.Random(3)
    out = [None, "", " \n", "#", "# a", "# a\n", "#\n", "# " + "x" * 2000, "# " + "x" * 2000 + "\nrest", "#" * 3000, "\n" * 2000, "a" + "\n" * 2000 + "b", "　a　", "é" * 1600 + " b"]
    out += ["\n\n# t\n\n" + "y" * (n + d) + end for n, d, end in itertools.product((200, 1500, 1600), (-7, -6, -1, 0, 1), ("", "\n", "  ", "\n\nz", "## z", " #\n\n# z", "\n" * 90 + "z"))]
    for _ in range(400):
        piece = rng.choice(["ab#\n ", "#\n", "a\n", "x# \t　"])
        out.append("".join(rng.choice(piece) for _ in range(rng.choice([5, 190, 210, 400, 1500, 1600, 1700, 3000]))) + rng.choice(["", "q" * 300, "#\n\n#", " " * 50]))
    return out


def test_previews_and_contents_are_those_of_whole_bodies(spark):
    body, heading = F.col("body"), F.lit(r"(?d)\A#.*\n")
    whole = strip(F.substring(apply_rules(F.regexp_replace(strip(body), heading, F.lit("")), ((r"\n{2,}", " "), (r"#+\s", ""))), 1, 200))
    rows = spark.createDataFrame([(b,) for b in bodies()], "body string")
    rows = rows.select("body", fm.preview(body).alias("p"), whole.alias("wp"), fm.content(body).alias("c"), F.substring(strip(body), 1, 1500).alias("wc"))
    assert [r for r in rows.collect() if r["p"] != r["wp"] or r["c"] != r["wc"]] == []
    assert "substring(ltrim(" in plan(rows.select("p")) and "substring(ltrim(" in plan(rows.select("c"))


@pytest.mark.parametrize("rules", [w.UNWANTED, w.EMPHASIS, w.LINKS, w.HEADINGS, w.DEFINITIONS[:1], (w.BLANK_LINES, w.LEADING_BLANKS, w.EMPTY_ITEM)])
def test_needed_rules_are_the_plain_rules(spark, rules):
    rng = random.Random(4)
    marks = ["<", "<!--", "-->", "<ref", "/>", "</ref>", "[[", "]]", "[[File:", "[http://e.c ", "]", "{{", "}}", "{{#invoke:", "{|", "|}", "|", "''", "'''", "=", "==", "===", "=" * 9, "\n", "\n\n", " ", "*", "-", ";", ":", "a", "b=c"]
    texts = [None, ""] + ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 25))) for _ in range(1500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", w.apply_needed(F.col("t"), rules, w.NEEDED).alias("a"), apply_rules(F.col("t"), rules).alias("b"))
    assert [r for r in rows.collect() if r["a"] != r["b"]] == []


def test_a_text_without_marks_is_looked_through_once_for_each_kind(spark):
    text = plan(spark.range(1).select(w.apply_needed(F.col("id").cast("string"), w.HEADINGS, w.NEEDED).alias("x")))
    first = text[text.index("Contains(") :]
    assert first[: first.index(")")].endswith(", =")  # the shallowest mark is asked for first, around all deeper ones


def test_numbered_entries_hold_what_lists_are_made_of(spark, sf_dir):
    made = queries.queries()["posting_counts"](spark, sf_dir)
    assert set(spark.read.parquet(*made.inputFiles()).columns) == {"title", "categories", "preview", "category_dir", "entry"}


def test_an_entry_query_searches_once(spark, sf_dir):
    idx = queries.materialize(queries._index(spark, sf_dir), "index")
    for q, bucket in queries_io.ASKED:
        assert plan(services.entry_query(idx, q, bucket)).count("FileScan") == (1 if q.strip() else 0)
