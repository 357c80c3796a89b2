"""A deterministic wiki corpus made from the table ``documents``, in both engines' SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BASE_URL
from ..functions import names
from ..functions.wikitext import parse_markdown, sql_markdown
from ..storage import read_table

_HEAD = """SELECT doc_id AS page_id,
  CASE doc_id % 13 WHEN 0 THEN 'Category:' WHEN 1 THEN 'Help:' ELSE '' END || source || ' p' || doc_id
    || CASE doc_id % 19 WHEN 0 THEN '/模板' WHEN 1 THEN ' 简介' ELSE '' END AS title,
  (doc_id * 7919) % 1000 + 1 AS revision_id,
  CASE WHEN doc_id % 23 = 0 THEN {a}'BanG Dream!', '消歧义页'{z}
       WHEN lang = 'en' THEN {a}'BanG Dream!', 'BanG Dream!角色'{z}
       WHEN lang = 'fr' THEN {a}'BanG Dream!歌曲', '动画'{z}
       WHEN lang = 'de' THEN {a}source || '配音角色'{z}
       WHEN doc_id % 2 = 0 THEN {a}'MyGO!!!!!乐队', '角色'{z}
       ELSE {a}'未知分类'{z} END AS categories,
  CASE WHEN doc_id % 17 = 0 THEN source END AS redirect_target,
  CASE doc_id % 17
    WHEN 0 THEN 'Redirect to: ' || source
    WHEN 1 THEN ''
    WHEN 2 THEN '{{{{disambig}}}}' || text
    ELSE """

_SHAPES = """
          WHEN 0 THEN '== ' || substr(x, 1, 12) || ' ==' || chr(10) || x
          WHEN 1 THEN '* ' || x
          WHEN 2 THEN '## ' || x
          WHEN 3 THEN '=== ' || substr(x, 1, 8) || ' ===' || repeat(chr(10), 4) || x
          WHEN 4 THEN x || '<ref name="a">cite</ref> [[File:a.jpg|thumb]] [[Category:X]]'
          WHEN 5 THEN 'see [[' || substr(x, 1, 6) || '|' || substr(x, 2, 4) || ']] [[' || substr(x, 1, 5) || ']] {{tpl|a=1}} ' || x
          WHEN 6 THEN repeat(chr(39), 3) || substr(x, 1, 4) || repeat(chr(39), 3) || ' ' || x
          WHEN 7 THEN '----' || chr(10) || '[http://e.com/a ' || substr(x, 1, 4) || '] <br/>' || x
          WHEN 8 THEN '== ' || substr(x, 1, 9) || ' ==' || chr(10) || '<!-- c -->{{#invoke:M|f}}{| t |} a < b > c ' || x
          ELSE '; ' || substr(x, 1, 5) || ' : ' || x || chr(10) || '*' || chr(10) || '  ** ' || substr(x, 1, 7) END"""

SPARK_PAGES = _HEAD.format(a="array(", z=")") + "array_join(transform(split(text, chr(10)), (x, i) -> CASE i % 10" + _SHAPES + "), chr(10)) END AS wikitext FROM documents"
DUCKDB_PAGES = _HEAD.format(a="[", z="]") + "array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: CASE (i - 1) % 10" + _SHAPES + "), chr(10)) END AS wikitext FROM documents"


def wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, title, revision_id, categories, redirect_target, wikitext)."""
    docs = read_table(spark, f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    docs.createOrReplaceTempView("quernstone_documents")
    return spark.sql(SPARK_PAGES.replace("FROM documents", "FROM quernstone_documents"))


def parsed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``wiki_pages`` with display_title, url, updated and markdown."""
    p = wiki_pages(spark, sf_dir)
    return p.select(
        "*",
        names.display_title(F.col("title")).alias("display_title"),
        names.page_url(F.col("title")).alias("url"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("page_id") % 200).cast("int")).cast("timestamp").alias("updated"),
        parse_markdown(F.col("wikitext")).alias("markdown"),
    )


def sectioned_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``parsed_pages`` whose headings vary, so that every branch of the splitter is taken."""
    p, md = parsed_pages(spark, sf_dir), F.col("markdown")
    demoted = F.regexp_replace(md, F.lit(r"(?dm)^## "), F.lit("### "))
    dropped = F.regexp_replace(md, F.lit(r"(?dm)^#+ "), F.lit(""))
    shaped = F.when(F.col("page_id") % 4 == 0, demoted).when(F.col("page_id") % 4 == 1, dropped).when(F.col("page_id") % 4 == 2, F.concat(F.lit("before all\n\n"), md)).otherwise(md)
    return p.withColumn("markdown", shaped)


def sql_parsed() -> str:
    """CTEs ``wiki_pages`` and ``parsed`` for DuckDB."""
    title = names.sql_display_title("title")
    return f"""wiki_pages AS MATERIALIZED ({DUCKDB_PAGES}),
parsed AS MATERIALIZED (SELECT *, {title} AS display_title, '{BASE_URL}/' || url_encode(title) AS url,
  CAST(DATE '2026-01-01' + CAST(page_id % 200 AS INTEGER) AS TIMESTAMP) AS updated, {sql_markdown("wikitext")} AS markdown FROM wiki_pages)"""


def sql_sectioned() -> str:
    return sql_parsed() + """,
sectioned AS MATERIALIZED (SELECT * REPLACE (CASE page_id % 4 WHEN 0 THEN regexp_replace(markdown, '(?m)^## ', '### ', 'g')
  WHEN 1 THEN regexp_replace(markdown, '(?m)^#+ ', '', 'g') WHEN 2 THEN 'before all' || chr(10) || chr(10) || markdown ELSE markdown END AS markdown) FROM parsed)"""


def category_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A category graph: root, regions, nations (with ways back to their regions), customers and suppliers as pages."""

    def t(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    region, nation = F.concat(F.lit("Category:r"), F.col("r_regionkey").cast("string")), F.concat(F.lit("Category:n"), F.col("n_nationkey").cast("string"))
    above = F.concat(F.lit("Category:r"), F.col("n_regionkey").cast("string"))
    sub, page = F.lit("subcat").alias("page_type"), F.lit("page").alias("page_type")
    edges = t("region").select(F.lit("Category:root").alias("parent"), region.alias("title"), sub)
    edges = edges.unionByName(t("nation").select(above.alias("parent"), nation.alias("title"), sub))
    edges = edges.unionByName(t("nation").select(nation.alias("parent"), above.alias("title"), sub))
    edges = edges.unionByName(t("customer").select(F.concat(F.lit("Category:n"), F.col("c_nationkey").cast("string")).alias("parent"), F.col("c_name").alias("title"), page))
    return edges.unionByName(t("supplier").select(F.concat(F.lit("Category:r"), (F.col("s_nationkey") % 5).cast("string")).alias("parent"), F.col("s_name").alias("title"), page))


SQL_EDGES = """edges AS (SELECT 'Category:root' AS parent, 'Category:r' || r_regionkey AS title, 'subcat' AS page_type FROM region
  UNION ALL SELECT 'Category:r' || n_regionkey, 'Category:n' || n_nationkey, 'subcat' FROM nation
  UNION ALL SELECT 'Category:n' || n_nationkey, 'Category:r' || n_regionkey, 'subcat' FROM nation
  UNION ALL SELECT 'Category:n' || c_nationkey, c_name, 'page' FROM customer
  UNION ALL SELECT 'Category:r' || (s_nationkey % 5), s_name, 'page' FROM supplier)"""
