"""Markup: worked examples."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quernstone.functions import wikitext as w

EXAMPLES = [
    ("", ""),
    (None, ""),
    ("Redirect to: X", ""),
    ("hello", "hello"),
    ("a '''b''' c", "a **b** c"),
    ("a ''b'' c", "a *b* c"),
    ("'''x''' r", "- x** r"),
    ("''x'' r", "- x* r"),
    ("## x", "1. x"),
    ("** deep", "- deep"),
    ("; term : def", "term : def"),
    ("{{a|{{b}}}}z", "}}z"),
    ("<ref name=a/>keep<ref>b</ref>end", "end"),
    ("a < b > c", "a  c"),
    ("== A ==\nbody", "## A\n\nbody"),
    ("=== B ===", "### B"),
    ("==== C ====", "#### C"),
    ("======= D =======", "####### D"),
    ("== A ==\n  \nfoo", "## A\n\nfoo"),
    ("[[T|D]] [[T]] [[help:x]]", "D T"),
    ("[http://e.com/a  txt] [http://e.com/b ]", "[txt](http://e.com/a) [http://e.com/b](http://e.com/b)"),
    ("*\nx", "x"),
    ("x\n-----\ny", "x\n---\ny"),
    ("a{{#invoke:T|m}}b", "ab"),
    ("p\n\n\n\nq", "p\n\nq"),
    ("a\n*\n\n*\nb", "a\n\nb"),
    ("x[[Category:A]]y", "xy"),
    ("x[[File:a.jpg|thumb]]y[[文件:b.png]]", "xy"),
    ("a<!-- c\nd -->b", "ab"),
    ("{| t\n| x |}z", "z"),
    ("# one\n# two", "1. one\n1. two"),
    ("* a\n* b", "- a\n- b"),
]


def column(spark, texts, f):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.select("i", f(F.col("t")).alias("x")).orderBy("i").select("x").collect()]


def test_examples(spark):
    got = column(spark, [a for a, _ in EXAMPLES], w.parse_markdown)
    assert got == [b for _, b in EXAMPLES]


def test_repaired(spark):
    texts = ["'''x''' r", "''x'' r", "* a\n** b"]
    assert column(spark, texts, lambda t: w.parse_markdown(t, strict=False)) == ["**x** r", "*x* r", "- a\n  - b"]


def test_fallback(spark):
    assert column(spark, ["a[[Category:X]] [[P|q]] [[plain]]== no\n== H ==\nt"], w.fallback_clean) == ["a q == no\n\n## H\n\nt"]


def test_definitions(spark):
    texts = ["; term : def ", "x", ";\nfoo:bar", ";a:\n b c \nd", ";a:b:c", "; : x", "a ;b:c"]
    assert column(spark, texts, w.convert_definitions) == ["**term**: def", "x", ";\nfoo:bar", "**a**: b c\nd", "**a**: b:c", "****: x", "a ;b:c"]


def test_headings_of_any_level(spark):
    text = "\n".join(f"{'=' * n} H{n} {'=' * n}" for n in (1, 2, 9, 10, 12, 30)) + "\na == b"
    got = [x for x in column(spark, [text], w.convert_headings)[0].split("\n") if x]
    assert got == [f"{'#' * n} H{n}" for n in (1, 2, 9, 10, 12, 30)] + ["a == b"]


def chunks(spark, markdown, threshold):
    rows = spark.createDataFrame([("T", markdown)], "display_title string, markdown string")
    out = w.split_long_pages(rows, threshold).orderBy("chunk_no")
    return [(r["chunk_title"], r["chunk_markdown"], r["section_level"], r["n_chunks"]) for r in out.collect()]


def test_short_page_is_one_chunk(spark):
    assert chunks(spark, "abc", 3) == [("T", "abc", 2, 1)]


def test_sections_and_preamble(spark):
    md = "pre\n\n## A\n\n" + "a" * 20 + "\n\n## B\n\nb"
    assert chunks(spark, md, 30) == [("T - A", "pre\n\n## A\n\n" + "a" * 20, 2, 2), ("T - B", "## B\n\nb", 2, 2)]


def test_one_section_with_preamble_is_one_chunk(spark):
    assert chunks(spark, "pre\n\n## A\n\n" + "a" * 30, 35) == [("T - A", "pre\n\n## A\n\n" + "a" * 30, 2, 1)]


def test_level_three(spark):
    md = "## A\n\nx\n\n### S\n\n" + "s" * 40 + "\n\n## B\n\nb"
    assert chunks(spark, md, 30) == [("T (1-1)", "## A\n\nx", 3, 3), ("T - S", "### S\n\n" + "s" * 40, 3, 3), ("T - B", "## B\n\nb", 2, 3)]


def test_no_headings(spark):
    assert len(chunks(spark, "x" * 50, 10)) == 1


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab =*#;:'[]{}|<>-!\n"), max_size=60), min_size=5, max_size=20))
def test_invariants(spark, texts):
    for out in column(spark, texts, w.parse_markdown):
        assert "<!--" not in out or "-->" not in out.split("<!--", 1)[1]
        assert all(line == line.rstrip() for line in out.split("\n"))


def test_control_characters_stay_in_place(spark):
    """Characters that the rules use as marks are text like any other when a page holds them."""
    texts = ["x\x02 y", "a \x03 b\x04", "; t\x02 : d\x03\n\x050\x05", "\x01\x01"]
    assert column(spark, texts[:2] + texts[3:], w.convert_definitions) == texts[:2] + texts[3:]
    assert column(spark, [";t\x02 : d\x03 \n\x050\x05"], w.convert_definitions) == ["**t\x02**: d\x03\n\x050\x05"]
    assert column(spark, [";t : d \nx"], w.convert_definitions) == ["**t**: d\nx"]
    plain = "before\n## A\none\n## B\ntwo"
    marked = plain.replace("o", "o\x01\x054")
    for level in (2, 3):
        parts = [column(spark, [x], lambda c, n=level: w.split_by_heading(c, n))[0] for x in (plain, marked)]
        assert [tuple(x and x.replace("o", "o\x01\x054") for x in p) for p in parts[0]] == [tuple(p) for p in parts[1]]


def test_trimming_takes_the_white_space_that_a_pattern_takes(spark):
    from quernstone.functions.rules import lstrip, rstrip, strip

    texts = spark.createDataFrame([(f"{chr(c)}\n a {chr(c)} b\u3000{chr(c)}",) for c in range(1, 0xD800)] + [("",), (" \u2028",), (None,)], "t string")
    same = [strip(F.col("t")).eqNullSafe(F.regexp_replace("t", F.lit(r"(?U)^\s+|\s+\z"), F.lit(""))), lstrip(F.col("t")).eqNullSafe(F.regexp_replace("t", F.lit(r"(?U)^\s+"), F.lit(""))),
            rstrip(F.col("t")).eqNullSafe(F.regexp_replace("t", F.lit(r"(?U)\s+\z"), F.lit("")))]
    assert texts.where(~(same[0] & same[1] & same[2])).count() == 0


def test_rules_left_out_change_nothing(spark):
    import itertools
    import random

    from quernstone.functions import wikitext as w
    from quernstone.functions.rules import apply_rules

    draw, bits = random.Random(5), ["<!--", "-->", "<ref", ">", "</ref>", "/>", "[[", "]]", "|", "File:", "Category:x", "{{", "}}", "#invoke:", "{|", "|}", "a=", "'''", "''", "[http://e", " ", "]", "----", "=", "==", "===", ";", ":", "-", "*", "\n", "\n", "\n\n\n", "x", "\u3000", "\t"]
    texts = spark.createDataFrame([("".join(draw.choices(bits, k=draw.randint(1, 30))),) for _ in range(4000)], "t string").repartition(4)
    t = F.col("t")
    assert not set(w.NEEDED) - set(itertools.chain(w.UNWANTED, w.EMPHASIS, w.LINKS, w.HEADINGS, w.DEFINITIONS, (w.RULER, w.BLANK_LINES)))
    for made, plain in ((w.remove_unwanted(t), w.UNWANTED), (w.convert_emphasis(t), w.EMPHASIS), (w.convert_links(t), w.LINKS), (w.convert_headings(t), w.HEADINGS), (w.convert_rulers(t), (w.RULER,)), (w.convert_definitions(t), w.DEFINITIONS)):
        assert texts.where(~made.eqNullSafe(apply_rules(t, plain))).count() == 0


def test_pages_are_parsed_once_for_the_index_document(spark):
    from quernstone.operators import render

    parsed = F.regexp_replace(F.when(F.col("id") > 3, F.when(F.col("id") > 7, "x").otherwise("")), "y", "z")
    pages = spark.range(40).select(F.lit("t").alias("display_title"), F.lit("u").alias("url"), F.array(F.lit("c")).alias("categories"), F.col("id").alias("revision_id"), F.lit("2026-01-02").alias("updated"),
                                   F.lit(None).cast("string").alias("redirect_target"), parsed.alias("markdown"))
    rows = render.index_rows(pages.withColumn("redirect_target", F.when(F.col("revision_id") == 9, "r")))
    assert len(rows.collect()) == 31 and rows._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 1
