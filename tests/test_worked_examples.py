"""Small worked examples of pages, files and the cache, written out."""

import pytest
from pyspark.sql import functions as F

from quernstone.functions import wikitext as w
from quernstone.operators import graph, render, stats
from quernstone.sources import sqlite

#: Wiki text, what its Markdown holds, and what it does not.
HELD = [
    ("这是一段纯文本。", ["这是一段纯文本"], []),
    ("这是'''加粗'''文本。", ["**加粗**"], ["'''"]),
    ("这是''斜体''文本。", ["*斜体*"], ["''"]),
    ("== 概述 ==\n概述内容\n== 详细 ==\n=== 子节 ===\n详细内容", ["## 概述", "## 详细", "### 子节"], ["=="]),
    ("==== 四级标题 ====\n正文", ["#### 四级标题"], ["="]),
    ("参见[[千早爱音|爱音]]。", ["参见爱音。"], ["千早", "[["]),
    ("参见[[千早爱音]]。", ["参见千早爱音。"], ["[["]),
    ("正文[[Category:BanG Dream!]][[File:Test.jpg|thumb]]", ["正文"], ["Category:", "File:"]),
    ("{{Infobox|name=测试}}正文{{Navbox|标题=导航}}结尾", ["正文", "结尾"], ["Infobox", "Navbox", "导航"]),
    ("正文<ref>引用内容</ref><!-- 注释 -->结尾{{#invoke:Test|main}}", ["正文", "结尾"], ["ref", "引用内容", "注释", "#invoke"]),
    ("正文\n\n\n\n\n结尾", ["正文\n\n结尾"], ["\n\n\n"]),
]


def test_markdown_holds(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(HELD)], "i int, t string")
    got = {r["i"]: r["m"] for r in rows.select("i", w.parse_markdown(F.col("t")).alias("m")).collect()}
    for i, (_, inside, outside) in enumerate(HELD):
        assert all(x in got[i] for x in inside) and not any(x in got[i] for x in outside), got[i]


def page(title, categories, wikitext="== 概述 ==\n这是页面。", target=None):
    return title, f"https://zh.moegirl.org.cn/{title}", 12345, "2026-07-01 00:00:00", categories, target, wikitext


def files_of(spark, pages):
    schema = "title string, url string, revision_id long, updated string, categories array<string>, redirect_target string, wikitext string"
    p = spark.createDataFrame(pages, schema).withColumn("display_title", F.col("title")).withColumn("markdown", w.parse_markdown(F.col("wikitext")))
    return {r["path"]: r["content"] for r in render.render_files(p).collect()}


def test_one_file(spark):
    assert files_of(spark, [page("千早爱音", ["BanG Dream!", "MyGO!!!!!"])]) == {
        "output/其它/千早爱音.md": "---\ntitle: 千早爱音\nurl: https://zh.moegirl.org.cn/千早爱音\nrevision: 12345\nupdated: '2026-07-01'\ncategories:\n- BanG Dream!\n- MyGO!!!!!\n---\n\n# 千早爱音\n\n## 概述\n\n这是页面。\n"
    }


@pytest.mark.parametrize("gone", [page("a", ["角色"], target="目标页面"), page("a", ["角色"], wikitext="")])
def test_pages_without_a_file(spark, gone):
    assert files_of(spark, [gone]) == {}


def test_files_by_directory(spark):
    found = files_of(spark, [page("页面A", ["BanG Dream!", "角色"]), page("页面B", ["歌曲"]), page("页面C", ["未知"])])
    assert sorted(found) == sorted(["output/角色/页面A.md", "output/歌曲/页面B.md", "output/其它/页面C.md"])


def test_cache_of_categories_statistics_and_counts(spark, tmp_path):
    path = str(tmp_path / "cache.db")
    cats = spark.createDataFrame([("Cat:A", 0, True), ("Cat:C", 2, False), ("Cat:B", 1, False)], "title string, depth int, crawled boolean")
    sqlite.write_table(cats, path, "categories")
    back = sqlite.read_table(spark, path, "categories").withColumn("crawled", F.col("crawled") == 1)
    assert [r["title"] for r in graph.uncrawled(back).collect()] == ["Cat:B", "Cat:C"]
    sqlite.write_table(cats.where("title = 'Cat:B'").withColumn("crawled", F.lit(True)), path, "categories")
    assert [r["title"] for r in graph.uncrawled(sqlite.read_table(spark, path, "categories").withColumn("crawled", F.col("crawled") == 1)).collect()] == ["Cat:C"]

    run = spark.createDataFrame([(100, 90, 3, 0, 0)], ", ".join(f"{c} long" for c in stats.COUNTERS[:3]) + ", pages_skipped long, pages_filtered long")
    sqlite.write_table(stats.to_key_values(run), path, "stats")
    assert stats.from_key_values(sqlite.read_table(spark, path, "stats")).first()[:3] == (100, 90, 3)

    pages = spark.createDataFrame([("页面1", "completed"), ("页面2", "completed"), ("页面3", "failed")], "title string, status string")
    sqlite.write_pages(pages, path)
    assert tuple(stats.table_counts(sqlite.read_pages(spark, path), back).first()) == (3, 2, 1, 3)
    sqlite.clean(path)
    assert [sqlite.read_table(spark, path, t).count() for t in sqlite.TABLES] == [0, 0, 0]
