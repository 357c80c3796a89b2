"""Files, indexes and cards: everything the engine writes or shows, as (path, content) or text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import frontmatter as fm
from ..functions import names
from ..functions.wikitext import split_long_pages
from .filters import directory_of

# Signs and sentences of the cards.
EMOJI = (("角色", "🎤"), ("歌曲", "🎵"), ("乐队", "🎸"), ("声优", "🎙️"))
OTHER_EMOJI = "📖"
DETAIL_FOOT = "\n📖 萌娘百科 · 本地知识库"
SEARCH_FOOT = "\n💡 输入 `/角色 xxx` `/歌曲 xxx` 可查看详情"
HELP = (
    "🎸 **BanG Dream! 知识库**\n\n"
    "`/角色 名字`     `角色 名字`     查询角色\n"
    "`/歌曲 歌名`     `歌曲 歌名`     查询歌曲\n"
    "`/乐队 名称`     `乐队 名称`     查询乐队\n"
    "`/声优 名字`     `声优 名字`     查询声优\n"
    "`/随机角色`                     随机角色\n"
    "`/随机歌曲`                     随机歌曲\n"
    "`/随机声优`                     随机声优\n"
    "`/萌百搜索 关键词`              全站搜索\n"
    "\n📖 萌娘百科 BanG Dream! 专题  ·  本地检索"
)


def render_files(pages: DataFrame, threshold: int = 5000, root: str = "output", plain_yaml: bool = False, normalize: bool = True, directory: Column | None = None, split: bool = True) -> DataFrame:
    """(title, chunk_no, n_chunks, directory, path, content) of parsed pages; redirects and empty pages have no file.

    ``pages`` has title, display_title, url, revision_id, updated, categories,
    redirect_target and markdown. ``plain_yaml`` keeps the front matter in the
    JVM, for values that YAML does not quote. A name is made once for a page:
    it comes out of a generator, above which filters on paths stay.
    """
    p = pages.where("redirect_target IS NULL").withColumn("file_stem", names.sanitize_filename(F.col("display_title"), normalize=normalize))
    p = p.select(*pages.columns, F.explode(F.array("file_stem")).alias("file_stem"))
    p = p.withColumn("directory", directory if directory is not None else directory_of(F.col("categories")))
    chunks = split_long_pages(p, threshold if split else (1 << 31) - 1, skip_empty=True)
    dump = fm.dump_plain if plain_yaml else fm.dump
    front = dump(F.col("chunk_title"), F.col("url"), F.col("revision_id"), names.short_date(F.col("updated")), F.col("categories"))
    content = F.concat(F.lit("---\n"), front, F.lit("---\n\n# "), F.col("chunk_title"), F.lit("\n\n"), F.col("chunk_markdown"), F.lit("\n"))
    suffix = F.when(F.col("n_chunks") > 1, F.concat(F.lit("_"), F.col("chunk_no").cast("string"))).otherwise("")
    path = names.named_path(F.col("file_stem"), F.col("directory"), root, suffix)
    return chunks.select("title", "chunk_no", "n_chunks", "directory", path.alias("path"), content.alias("content"))


def actor_files(fetched: DataFrame, root: str = "output", tags: tuple[str, ...] = ("BanG Dream!", "声优"), plain_yaml: bool = False) -> DataFrame:
    """Files of voice actors: two more categories, their own directory, never split; redirects are not looked for."""
    p = fetched.withColumn("categories", F.concat("categories", F.array(*(F.lit(t) for t in tags)).cast("array<string>"))).withColumn("redirect_target", F.lit(None).cast("string"))
    return render_files(p, root=root, plain_yaml=plain_yaml, directory=F.lit(C.ACTOR_DIR), split=False)


def export_counts(pages: DataFrame, files: DataFrame) -> DataFrame:
    """Files written and pages skipped."""
    skipped = pages.agg(F.count_if(F.col("redirect_target").isNotNull() | (F.coalesce(F.trim("markdown"), F.lit("")) == "")).alias("skipped_files"))
    return files.agg(F.count("*").alias("exported_files")).join(F.broadcast(skipped), F.lit(True))  # one row each


def index_rows(pages: DataFrame) -> DataFrame:
    """Entries of the index document: no redirects, no empty pages; a missing date stays as null.

    Empty pages are left out by a generator: a filter would go below what makes the text, and make it once for each
    mention besides.
    """
    p = pages.where("redirect_target IS NULL")
    p = p.select("display_title", "url", "categories", "revision_id", "updated", F.explode(F.filter(F.array(F.length("markdown")), lambda n: n > 0)).alias("n_chars"))
    return p.select(
        F.col("display_title").alias("title"), "url", "categories", F.col("revision_id").alias("revision"),
        names.short_date(F.col("updated")).alias("updated"), directory_of(F.col("categories")).alias("directory"),
    )


def index_json(pages: DataFrame) -> DataFrame:
    """(title, entry): each entry of the index document as JSON, nulls kept."""
    rows = index_rows(pages)
    return rows.select("title", F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("entry"))


def emoji(bucket: Column) -> Column:
    out = F.lit(OTHER_EMOJI)
    for name, sign in EMOJI:
        out = F.when(bucket == name, sign).otherwise(out)
    return out


def _cut(body: Column, most: int, start: int, stop: int, least: int) -> Column:
    """``body`` cut at the last full stop or line end in [start, stop), at ``least`` at the earliest, if it is longer than ``most``."""
    part = F.substring(body, start + 1, stop - start)

    def last(mark: str) -> Column:
        at = F.instr(F.reverse(part), mark)
        return F.when(at > 0, F.lit(start) + F.length(part) - at).otherwise(-1)

    cut = F.greatest(last("。"), last("\n"), F.lit(least))
    return F.when(F.length(body) > most, F.concat(F.substring(body, F.lit(1), cut), F.lit("…"))).otherwise(body)


def detail_card(title: Column, bucket: Column, content: Column, most: int = 1200) -> Column:
    body = _cut(fm.clean(content), most, most - 200, most, most - 100)
    return F.concat(emoji(bucket), F.lit(" **"), title, F.lit("**\n\n"), body, F.lit("\n" + DETAIL_FOOT))


def random_card(title: Column, bucket: Column, content: Column) -> Column:
    body = _cut(fm.clean(content), 700, 600, 750, 600)
    return F.concat(F.lit("🎲 "), emoji(bucket), F.lit(" **"), title, F.lit("**\n\n"), body, F.lit("\n\n`/随机"), bucket, F.lit("` 换一个"))


def result_list(results: DataFrame, query: str, bucket: str = "") -> DataFrame:
    """(text): numbered results with short previews; a sentence if there are none."""
    return results.agg(list_text(query, bucket).alias("text"))


def list_text(query: str, bucket: str = "") -> Column:
    """The text of :func:`result_list`, as an aggregate of results."""
    pv = fm.short_preview(F.col("preview"), 100)
    item = F.concat(F.lit("  "), F.col("rank").cast("string"), F.lit(". "), F.col("title"), F.when(pv != "", F.concat(F.lit("\n     "), pv)).otherwise(""))
    n, items = F.count("*"), F.array_sort(F.collect_list(F.struct("rank", item.alias("item"))))
    found = F.concat(F.lit(f"🔍 **「{query}」** — 共 "), n.cast("string"), F.lit(" 条结果\n\n"), F.array_join(F.transform(items, lambda x: x["item"]), "\n"), F.lit("\n" + SEARCH_FOOT))
    none = f"🔍 搜索 **「{query}」**（{bucket or '全部'} · 本地）\n\n未找到相关结果。\n\n试试：缩短关键词  换用中文/日文  用 `/随机{bucket}` 浏览"
    return F.when(n > 0, found).otherwise(none)


def error_text(message: str) -> str:
    return f"⚠️ {message}"


def not_found_text(query: str, bucket: str = "") -> str:
    return f"未在{f'{bucket}内' if bucket else ''}找到「{query}」\n\n试试 `/萌百搜索 {query}` 或 `/随机{bucket}`"
