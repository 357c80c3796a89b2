"""The text reports of the quality tools as rows (section, part, key, line): in this order they are the report.

Lists are distributed rows, never gathered; only ``files.write_report`` puts
a report into one file. Headings and sentences are fixed values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import frontmatter as fm
from ..functions.rules import java, strip
from ..storage import materialize
from . import quality

RULE = "=" * 60
SCAN_TITLE, DEEP_TITLE, REPAIR_TITLE = "质量报告 - output 目录 Markdown 文件扫描", "深度扫描结果", "自动修复详细报告"
DANGLING_ISSUE, TRUNCATED_ISSUE, DASHES_DONE, DELETED = "categories末尾有空项", "ends with heading", "移除空的categories条目", "空注释页: "
SHORTEST, NAMES_SHOWN = 30, 30
_SCHEMA = "section int, part int, key string, line string"


def _rows(rows: DataFrame, section: int, part: int, key: Column, line: Column) -> DataFrame:
    return rows.select(F.lit(section).alias("section"), F.lit(part).alias("part"), key.cast("string").alias("key"), line.alias("line"))


def _text(one: DataFrame, lines: list[tuple[int, int, list[str | Column]]]) -> DataFrame:
    """Lines (section, part, pieces) over a frame of one row."""
    made = [F.struct(F.lit(s).alias("section"), F.lit(p).alias("part"), F.lit("").alias("key"), F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in pieces)).alias("line")) for s, p, pieces in lines]
    return one.select(F.explode(F.array(*made)).alias("x")).select("x.*")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _item(path: Column) -> Column:
    return F.concat(F.lit("  - "), path)


def _listed(values: Column) -> Column:
    """Texts as a list is printed."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, lambda v: F.concat(F.lit("'"), v, F.lit("'"))), ", "), F.lit("]"))


def _sized(n: Column) -> Column:
    """A key that puts larger numbers first."""
    return F.lpad((F.lit(10**12) - n).cast("string"), 13, "0")


def scan_report(files: DataFrame) -> DataFrame:
    """Empty, title-only and short files, leftover markup, copies, equal names, files by directory."""
    m = materialize(quality.file_metrics(files), "metrics")  # all branches read what is measured once
    path, named = F.col("path"), quality.groups(m, "file_name")
    copies, left = quality.duplicate_totals(m), quality.residue(files).groupBy("path").agg(F.collect_list("pattern").alias("found"))
    order = F.array(*(F.lit(n) for n, _ in quality.RESIDUE))
    left = materialize(left.select("path", F.filter(order, lambda n: F.array_contains("found", n)).alias("found")), "left")
    edges = list(zip(quality.SHORT_EDGES[:-1], quality.SHORT_EDGES[1:], strict=True))
    counts = m.agg(
        F.count("*").alias("files"), F.count_if("is_empty").alias("empty"), F.count_if("is_title_only").alias("title_only"), F.count_if("is_short").alias("short"),
        *(F.count_if(F.col("is_short") & (F.col("words") >= a) & (F.col("words") < b)).alias(f"n{a}") for a, b in edges),
    )
    one = counts
    for extra in (copies, left.agg(F.count("*").alias("left")), named.agg(F.count("*").alias("names"))):
        one = one.join(F.broadcast(extra), F.lit(True))  # one row each
    percent = F.coalesce(F.floor(F.try_divide(F.col("short") * 100, F.col("files"))), F.lit(0))
    head = [
        (0, 0, [RULE]), (0, 1, [SCAN_TITLE]), (0, 2, [RULE]), (0, 3, ["\n总 Markdown 文件数: ", F.col("files")]),
        (1, 0, ["\n", RULE]), (1, 1, ["## 1. 空文档 (0 字节或仅空白字符)"]), (1, 2, ["数量: ", F.col("empty")]),
        (2, 0, ["\n", RULE]), (2, 1, ["## 2. 仅含标题的文档 (正文 < 10 字符)"]), (2, 2, ["数量: ", F.col("title_only")]),
        (3, 0, ["\n", RULE]), (3, 1, ["## 3. 短文档 (< 300 字)"]), (3, 2, ["数量: ", F.col("short"), " (", percent, "%)"]), (3, 3, ["\n字数分布:"]),
        *((3, 4 + i, [f"  {a}-{b}字: ", F.col(f"n{a}"), " 个文件"]) for i, (a, b) in enumerate(edges)), (3, 9, ["\n最短的 30 个文档:"]),
        (4, 0, ["\n", RULE]), (4, 1, ["## 4. Wiki 残留"]), (4, 2, ["含有 Wiki 残留的文件数: ", F.col("left")]),
        (5, 0, ["\n", RULE]), (5, 1, ["## 5. 重复文档"]), (5, 2, ["重复组数量: ", F.col("n_groups")]), (5, 3, ["涉及文件总数: ", F.col("n_files")]),
        (6, 0, ["\n## 6. 同名文件 (不同目录)"]), (6, 1, ["同名文件组数: ", F.col("names")]),
        (7, 0, ["\n", RULE]), (7, 1, ["## 7. 子目录分布"]),
    ]
    shown = quality.same_names(m, NAMES_SHOWN)
    members = m.where("NOT is_empty").select("file_name", "path").join(F.broadcast(shown), "file_name")  # at most 30 rows are broadcast
    key = F.concat("file_name", F.lit("\x00"))
    return _union([
        _text(one, head),
        _rows(m.where("is_empty"), 1, 3, path, _item(path)), _rows(m.where("is_title_only"), 2, 3, path, _item(path)),
        _rows(quality.shortest(m, SHORTEST), 3, 10, F.concat(F.lpad(F.col("words").cast("string"), 13, "0"), path), F.concat(F.lit("  ["), F.col("words").cast("string"), F.lit("字] "), path)),
        _rows(left, 4, 3, path, F.concat(_item(path), F.lit(": "), _listed(F.col("found")))),
        _rows(shown, 6, 2, key, F.concat(F.lit("  - "), F.col("file_name"), F.lit(": "), F.col("n").cast("string"), F.lit(" 个"))),
        _rows(members, 6, 2, F.concat(key, path), F.concat(F.lit("      "), path)),
        _text(one.where(F.col("names") > NAMES_SHOWN), [(6, 3, ["  ... 还有 ", F.col("names") - NAMES_SHOWN, " 组"])]),
        _rows(quality.files_per_directory(m), 7, 2, F.col("directory"), F.concat(F.lit("  "), F.col("directory"), F.lit(": "), F.col("n_files").cast("string"), F.lit(" 个文件"))),
    ])


def deep_report(files: DataFrame) -> DataFrame:
    """Empty bodies, pages of references alone, wiki links, front-matter faults, cut texts, near-copies."""
    m = materialize(quality.file_metrics(files), "metrics")
    path = F.col("path")
    links = materialize(quality.wiki_links_left(files.join(m.where("NOT is_empty").select("path"), "path", "left_semi")), "links")
    near = quality.groups(m, "fingerprint")
    one = m.agg(*(F.count_if(c).alias(c) for c in ("is_empty_body", "is_reference_only", "has_dangling", "is_truncated")))
    for extra in (links.agg(F.count("*").alias("links")), near.agg(F.count("*").alias("near"))):
        one = one.join(F.broadcast(extra), F.lit(True))  # one row each
    head = [
        (0, 0, [RULE]), (0, 1, [DEEP_TITLE]), (0, 2, [RULE]), (1, 0, ["\n## A. 空正文文档: ", F.col("is_empty_body")]), (2, 0, ["\n## B. 仅含注释的空文档: ", F.col("is_reference_only")]),
        (3, 0, ["\n## C. Wiki双括号链接: ", F.col("links")]), (4, 0, ["\n## D. Frontmatter问题: ", F.col("has_dangling")]), (5, 0, ["\n## E. 截断内容: ", F.col("is_truncated")]), (6, 0, ["\n## F. 近似重复组: ", F.col("near")]),
    ]
    members = quality.group_members(m, "fingerprint").join(near.select("fingerprint", "n"), "fingerprint")
    key = F.concat(_sized(F.col("n")), F.sha2(F.col("fingerprint").cast("binary"), 256))
    return _union([
        _text(one, head),
        _rows(m.where("is_empty_body"), 1, 1, path, _item(path)), _rows(m.where("is_reference_only"), 2, 1, path, _item(path)),
        _rows(links, 3, 1, path, F.concat(_item(path), F.lit(": "), _listed(F.split("targets", "\n", -1)))),
        _rows(m.where("has_dangling"), 4, 1, path, F.concat(_item(path), F.lit(f": {DANGLING_ISSUE}"))), _rows(m.where("is_truncated"), 5, 1, path, F.concat(_item(path), F.lit(f": {TRUNCATED_ISSUE}"))),
        _rows(near, 6, 1, key, F.concat(F.lit("  - ("), F.col("n").cast("string"), F.lit(" files):"))), _rows(members, 6, 1, F.concat(key, path), F.concat(F.lit("      "), path)),
    ])


def repair_log(files: DataFrame) -> DataFrame:
    """What the repair did: dashes removed, pages deleted, placeholders added."""
    title = F.regexp_extract(strip(fm.split_file(F.col("raw"))["body"]), java(r"(?m)^#\s+([^\n]+)"), 1)
    done = quality.repair(files).select("path", "raw", "action", "fixed_dashes").join(files.select("path", "file_name"), "path")
    done = materialize(done.select("path", "action", "fixed_dashes", F.coalesce(F.nullif(title, F.lit("")), F.col("file_name")).alias("title")), "done")
    path, deleted, added = F.col("path"), F.col("action") == "delete", F.col("action") == "placeholder"
    one = done.agg(F.count_if("fixed_dashes").alias("dashes"), F.count_if(deleted).alias("deleted"), F.count_if(added).alias("added"))
    head = [
        (0, 0, [REPAIR_TITLE]), (0, 1, [RULE]), (1, 0, ["Frontmatter修复: ", F.col("dashes")]), (2, 0, ["\n删除空页面: ", F.col("deleted")]), (3, 0, ["\n添加占位符: ", F.col("added")]),
        (4, 0, ["\n总计: ", F.col("dashes") + F.col("deleted") + F.col("added")]),
    ]
    return _union([
        _text(one, head),
        _rows(done.where("fixed_dashes"), 1, 1, path, F.concat(F.lit("  "), path, F.lit(f": {DASHES_DONE}"))),
        _rows(done.where(deleted), 2, 1, path, F.concat(F.lit("  "), path, F.lit(f": {DELETED}"), F.col("title"))),
        _rows(done.where(added), 3, 1, path, F.concat(F.lit("  "), path, F.lit(": "), F.col("title"))),
    ])


def numbered(report: DataFrame) -> DataFrame:
    """(line_no, line) for a text sink."""
    order = F.struct("section", "part", "key", "line")
    return report.select(order.alias("line_no"), "line")
