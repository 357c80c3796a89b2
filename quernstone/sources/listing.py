"""Category listing pages (HTML)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators.filters import title_reason

NEXT_LINK = "下一页"


def nav_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, link_no, href): first links of the list items of a page's navigation."""
    nav = F.regexp_extract(html_col, r"(?s)<nav[^>]*>(.*?)</nav>", 1)
    links = F.regexp_extract_all(nav, F.lit(r'<li[^>]*>\s*<a[^>]*href="([^"]*)"'), F.lit(1))
    return pages.select(id_col, F.posexplode(links).alias("link_no", "href")).withColumn("link_no", F.col("link_no").cast("long"))


def _unescape(text: Column) -> Column:
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def _region(html: Column, name: str) -> Column:
    """From the division of that id to the next division that has an id, or the end."""
    return F.regexp_extract(html, rf'(?s)<div[^>]*\bid="{name}"[^>]*>(.*?)(?:<div[^>]*\bid="|\z)', 1)


def members(listings: DataFrame, category_col: str = "category", html_col: str = "html") -> DataFrame:
    """(parent, title, page_type) of listing pages: sub-categories, then articles that the title filter keeps."""
    html = F.col(html_col)
    subs = F.regexp_extract_all(_region(html, "mw-subcategories"), F.lit(r'<a\b[^>]*\btitle="(Category:[^"]*)"'), F.lit(1))
    items = F.regexp_extract_all(_region(html, "mw-pages"), F.lit(r"(?s)<li\b[^>]*>(.*?)</li>"), F.lit(1))
    titles = F.transform(items, lambda x: F.regexp_extract(F.regexp_extract(x, r"(?s)<a\b[^>]*>", 0), r'\btitle="([^"]*)"', 1))

    def rows(found: Column, kind: str) -> Column:
        return F.transform(found, lambda t: F.struct(_unescape(t).alias("title"), F.lit(kind).alias("page_type")))

    out = listings.select(F.col(category_col).alias("parent"), F.explode(F.concat(rows(subs, "subcat"), rows(titles, "page"))).alias("m"))
    out = out.select("parent", "m.title", "m.page_type")
    return out.where((F.col("page_type") == "subcat") | ((F.col("title") != "") & title_reason(F.col("title")).isNull()))


def next_url(html: Column, base: str = C.BASE_URL) -> Column:
    """The address of the listing's next page; null if it is the last."""
    link = F.regexp_extract(html, rf'(?s)<a\b[^>]*\bhref="([^"]*)"[^>]*>[^<]*{NEXT_LINK}[^<]*</a>', 1)
    href = _unescape(link)
    return F.when(href == "", None).when(F.startswith(href, F.lit("/")), F.concat(F.lit(base), href)).when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(F.lit(base + "/"), href))


def page_from(url: Column) -> Column:
    return F.try_url_decode(F.regexp_extract(url, r"[?&]pagefrom=([^&#]*)", 1))
