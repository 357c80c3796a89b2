"""Queries of the operators around sources, sinks, reports and answers, and the same in DuckDB's SQL."""

from __future__ import annotations

import json
import re
import uuid
from urllib.parse import parse_qs, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config as C
from . import services
from .functions import frontmatter as fm
from .functions import names
from .functions.rules import quote, sql_strip
from .operators import filters, index, merge, postings, quality, render, reports, stats
from .operators.postings import StoredIndex
from .plans import fixtures as fx
from .plans import images, live
from .queries import (
    SEARCHES, _COUNTERS, _EMOJI_SQL, _FILES, _FLAWED, _INDEX, _REPAIR, _TAGGED, PARSED, _cut_sql, _counters, _docs, _files, _flawed_files, _index, _score_sql, query,
)
from .sources import api, files, sqlite
from .sources.pagetable import PageTable
from .storage import materialize, shared_dir


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/quernstone/{spark.sparkContext.applicationId}/files-{uuid.uuid4().hex}"


# ── table look-ups and merges ───────────────────────────────────────────────


@query(PARSED + f", {fx.SQL_EDGES} SELECT DISTINCT 'page' AS kind, title FROM parsed UNION ALL SELECT DISTINCT 'category', title FROM edges WHERE page_type = 'subcat'")
def distinct_titles(spark, sf_dir):
    pages, cats = fx.wiki_pages(spark, sf_dir), fx.category_edges(spark, sf_dir).where("page_type = 'subcat'")
    out = filters.distinct_titles(pages).select(F.lit("page").alias("kind"), "title")
    return out.unionByName(filters.distinct_titles(cats).select(F.lit("category").alias("kind"), "title"))


@query(_TAGGED + " SELECT page_id, title FROM tagged WHERE skip_reason IS NOT NULL")
def pages_by_status(spark, sf_dir):
    """The skipped pages out of the stored page table: a scan of their files alone."""
    table = PageTable(spark, _folder(spark))
    table.replace(filters.tag_pages(fx.wiki_pages(spark, sf_dir)))
    return table.by_status("skipped").select("page_id", "title")


def _page_table(spark: SparkSession, sf_dir: str) -> PageTable:
    table, day = PageTable(spark, _folder(spark)), F.lit("2026-01-01").cast("timestamp")
    p = fx.wiki_pages(spark, sf_dir).select("title", "page_id", "revision_id", F.when(F.col("page_id") % 4 == 0, "pending").otherwise("completed").alias("status"), "wikitext")
    table.replace(p.withColumns({"created_at": day, "updated_at": day}))
    return table


def _table_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = fx.wiki_pages(spark, sf_dir), F.col("page_id") % 6
    changed = p.where(k < 2).select("title", "page_id", (F.col("revision_id") + 1).alias("revision_id"), F.when(k == 0, "failed").otherwise("completed").alias("status"), F.when(k == 1, F.col("wikitext")).alias("wikitext"))
    new = p.where(k == 5).select(F.concat(F.lit("new "), F.col("title")).alias("title"), "page_id", "revision_id", F.lit("pending").alias("status"), "wikitext")
    return changed.unionByName(new)


_MERGED = f"""WITH p AS ({fx.DUCKDB_PAGES}), m AS (SELECT title, page_id, revision_id + CASE WHEN page_id % 6 < 2 THEN 1 ELSE 0 END AS revision_id,
  CASE WHEN page_id % 6 = 0 THEN 'failed' WHEN page_id % 6 = 1 THEN 'completed' WHEN page_id % 4 = 0 THEN 'pending' ELSE 'completed' END AS status, CASE WHEN page_id % 6 > 0 THEN wikitext END AS wikitext,
  TIMESTAMP '2026-01-01' AS created_at, CASE WHEN page_id % 6 < 2 THEN TIMESTAMP '2026-02-02' ELSE TIMESTAMP '2026-01-01' END AS updated_at FROM p
  UNION ALL SELECT 'new ' || title, page_id, revision_id, 'pending', wikitext, TIMESTAMP '2026-02-02', TIMESTAMP '2026-02-02' FROM p WHERE page_id % 6 = 5)"""


@query(_MERGED + " SELECT * FROM m")
def page_table_merge(spark, sf_dir):
    """The stored page table after changed and new pages were merged in, bucket by bucket."""
    table, now = _page_table(spark, sf_dir), F.lit("2026-02-02").cast("timestamp")
    table.merge(_table_changes(spark, sf_dir), lambda old, new: merge.upsert(old, new, "title", now))
    return table.read().select("title", "page_id", "revision_id", "status", "wikitext", "created_at", "updated_at")


@query(_MERGED + " SELECT 'src3 p3' AS asked, title, revision_id, status FROM m WHERE title = 'src3 p3' UNION ALL SELECT 'new src5 p5', title, revision_id, status FROM m WHERE title = 'new src5 p5'")
def page_table_lookup(spark, sf_dir):
    """Two pages by title, each out of its bucket, after a merge."""
    table, now = _page_table(spark, sf_dir), F.lit("2026-02-02").cast("timestamp")
    table.merge(_table_changes(spark, sf_dir), lambda old, new: merge.upsert(old, new, "title", now))
    found = [table.get(t).select(F.lit(t).alias("asked"), "title", "revision_id", "status") for t in ("src3 p3", "new src5 p5")]
    return found[0].unionByName(found[1])


# ── the stored index ────────────────────────────────────────────────────────


def _stored(spark: SparkSession, sf_dir: str) -> StoredIndex:
    path = _folder(spark)
    postings.build(_index(spark, sf_dir), path)
    return StoredIndex(spark, path)


_STORED = [(q, b, 8) for q in SEARCHES for b in ("", "角色")]


@query(
    _INDEX
    + "".join(f", s{i} AS (SELECT row_number() OVER (ORDER BY score DESC, dir_rank, file_name) AS rank, * FROM (SELECT *, {_score_sql(q)} AS score FROM idx{f' WHERE category_dir = {quote(b)}' if b else ''}) WHERE score > 0)" for i, (q, b, _) in enumerate(_STORED))
    + " UNION ALL ".join(f" SELECT {quote(q)} AS query, {quote(b)} AS bucket, rank, title, path, score FROM s{i} WHERE rank <= {n}" for i, (q, b, n) in enumerate(_STORED))
)
def stored_search(spark, sf_dir):
    """All searches over the stored index, in all buckets and in one: postings give the candidates, and these alone are scored."""
    stored, out = _stored(spark, sf_dir), None
    for q, b, n in _STORED:
        found = stored.search(q, b, n).select(F.lit(q).alias("query"), F.lit(b).alias("bucket"), F.col("rank").cast("long").alias("rank"), "title", F.col("filepath").alias("path"), "score")
        out = found if out is None else out.unionByName(found)
    return out


@query(_INDEX + " SELECT title, path FROM idx WHERE lower(title) = 'src3 p3' ORDER BY dir_rank, file_name LIMIT 1")
def stored_title_lookup(spark, sf_dir):
    return _stored(spark, sf_dir).get_by_title(" SRC3 P3 ").select("title", F.col("filepath").alias("path"))


@query(_INDEX + """, t AS (SELECT lower(title) AS title, category_dir, list_distinct(string_split(lower(title), '')) AS letters FROM idx)
SELECT c AS letter, category_dir, count(*) AS entries FROM (SELECT category_dir, unnest(letters) AS c FROM t) GROUP BY ALL""")
def posting_counts(spark, sf_dir):
    """How many entries the posting lists of the titles' letters hold."""
    index_ = _index(spark, sf_dir).select("title", "categories", "preview", "category_dir", F.monotonically_increasing_id().alias("entry"))
    lists = postings.postings_of(materialize(index_, "numbered")).where(F.startswith("token", F.lit(postings.TITLE_LETTER)))
    return lists.groupBy(F.substring("token", 2, 1).alias("letter"), "category_dir").agg(F.sum(F.size("entries")).alias("entries"))


@query(f"""WITH {fx.SQL_EDGES}, o AS (SELECT title, CAST(length(title) AS BIGINT) AS page_id, 1 AS depth, min(parent) AS parent, false AS crawled FROM edges WHERE page_type = 'subcat' AND length(title) % 2 = 0 GROUP BY title),
n AS (SELECT title, CAST(7 AS BIGINT) AS page_id, 2 AS depth, CAST(NULL AS VARCHAR) AS parent, true AS crawled FROM edges WHERE page_type = 'subcat' AND title <> 'Category:r1' GROUP BY title)
SELECT coalesce(n.title, o.title) AS title, coalesce(n.page_id, o.page_id) AS page_id, coalesce(n.depth, o.depth) AS depth, CASE WHEN n.title IS NULL THEN o.parent END AS parent, coalesce(n.crawled, o.crawled) AS crawled,
  CASE WHEN o.title IS NULL THEN TIMESTAMP '2026-02-02' ELSE TIMESTAMP '2026-01-01' END AS created_at FROM o FULL JOIN n ON o.title = n.title""")  # fmt: skip
def upsert_categories(spark, sf_dir):
    e = fx.category_edges(spark, sf_dir).where("page_type = 'subcat'")
    old = e.where("length(title) % 2 = 0").groupBy("title").agg(F.min("parent").alias("parent"))
    old = old.select("title", F.length("title").cast("long").alias("page_id"), F.lit(1).alias("depth"), "parent", F.lit(False).alias("crawled"), F.lit("2026-01-01").cast("timestamp").alias("created_at"))
    new = e.where("title <> 'Category:r1'").select("title").distinct()
    new = new.select("title", F.lit(7).cast("long").alias("page_id"), F.lit(2).alias("depth"), F.lit(None).cast("string").alias("parent"), F.lit(True).alias("crawled"))
    return merge.upsert_categories(old, new, F.lit("2026-02-02").cast("timestamp"))


# ── API answers ─────────────────────────────────────────────────────────────


@query("SELECT doc_id, CASE doc_id % 4 WHEN 2 THEN 'badtoken' END AS code FROM documents")
def api_errors(spark, sf_dir):
    k = F.col("doc_id") % 4
    body = F.when(k == 1, '{"error": {"code": "missingtitle"}}').when(k == 2, '{"error": {"code": "badtoken"}}').when(k == 3, "no JSON").otherwise('{"query": {}}')
    return _docs(spark, sf_dir).select("doc_id", api.api_error(body).alias("code"))


@query(PARSED + " SELECT title, CASE WHEN page_id % 3 = 0 OR wikitext = '' THEN CASE WHEN page_id % 2 = 0 THEN 'single ' || title ELSE '' END ELSE wikitext END AS wikitext FROM parsed")
def refetched_pages(spark, sf_dir):
    p = fx.wiki_pages(spark, sf_dir)
    batch = p.select("title", F.when(F.col("page_id") % 3 != 0, F.col("wikitext")).otherwise("").alias("wikitext"))
    return api.prefer_batch(batch, p.where("page_id % 2 = 0").select("title", F.concat(F.lit("single "), F.col("title")).alias("wikitext")))


@query("""SELECT doc_id, doc_id % 6 + 1 AS attempt, CASE WHEN doc_id % 6 < 4 THEN CAST(power(2, doc_id % 6) AS DOUBLE) END AS least, CASE WHEN doc_id % 6 < 4 THEN CAST(power(2, doc_id % 6) + 2 AS DOUBLE) END AS most FROM documents""")
def retry_waits(spark, sf_dir):
    """How long a request of each row waits after its failed attempt."""
    attempt = F.col("doc_id") % 6 + 1
    least, most = api.wait_bounds(attempt)
    return _docs(spark, sf_dir).select("doc_id", attempt.alias("attempt"), least.alias("least"), most.alias("most"))


def _answer(url: str) -> tuple[int, dict, str]:
    """A wiki of all titles, in which the number at a title's end decides what a request for it alone gets."""
    title = parse_qs(urlsplit(url).query)["titles"][0]
    k = int(re.search(r"p(\d+)", title)[1]) % 8
    if k in (3, 4):
        return (503, {}, "") if k == 3 else (429, {"Retry-After": "0"}, "")
    if k == 5:
        return 200, {}, f"<html>{api.AUTH_MARK}</html>"
    if k == 6:
        return 404, {}, ""
    if k == 2:
        return 200, {}, json.dumps({"error": {"code": "badtoken"}})
    found = {"title": title, "missing": ""} if k == 1 else {"title": title, "pageid": 7, "lastrevid": 8, "touched": "2026-01-02T03:04:05Z", "extract": f"About {title}."}
    return 200, {}, json.dumps({"query": {"pages": {"1": found}}})


_QUICK = C.Settings(rate_limit=0, jitter=0, titles_per_request=1, attempts=2, first_wait=0, retry_jitter=0)


@query(PARSED + """ SELECT title, CASE page_id % 8 WHEN 0 THEN 'completed' WHEN 7 THEN 'completed' ELSE 'failed' END AS status, CASE page_id % 8 WHEN 1 THEN 'missing' WHEN 2 THEN 'badtoken' WHEN 3 THEN 'server_error'
  WHEN 4 THEN 'rate_limit' WHEN 5 THEN 'auth_page' WHEN 6 THEN 'http_error' END AS error, CAST(CASE WHEN page_id % 8 IN (0, 7) THEN NULL WHEN page_id % 8 IN (3, 4) THEN 2 ELSE 1 END AS BIGINT) AS attempts FROM parsed WHERE NOT regexp_matches(title, '^(Category|Help):') AND NOT contains(title, '/')""")
def fetch_failures(spark, sf_dir):
    """Titles fetched by API, each with its status, and the cause and number of attempts where it failed."""
    titles = fx.wiki_pages(spark, sf_dir).where("NOT title RLIKE '^(Category|Help):' AND NOT contains(title, '/')").select("title")
    return live.fetch_wave(titles, f"{__name__}:_answer", _QUICK).select("title", "status", "error", F.col("attempts").cast("long").alias("attempts"))


@query(PARSED + """, w AS (SELECT title, CASE WHEN page_id % 5 = 1 THEN page_id % 3 END AS tries FROM parsed WHERE page_id % 5 < 3)
SELECT title, row_number() OVER (ORDER BY tries NULLS LAST, title) - 1 AS turn FROM w""")
def crawl_order(spark, sf_dir):
    """What a run asks for when it is taken up again: failed pages first, by attempts, then new ones; completed and skipped ones are done."""
    p, k = fx.wiki_pages(spark, sf_dir).select("title", "page_id"), F.col("page_id") % 5
    cached = p.where(k != 2).where(k != 0).select("title", F.when(k == 1, "failed").when(k == 3, "completed").otherwise("skipped").alias("status"), F.when(k == 1, F.col("page_id") % 3).cast("int").alias("attempts"))
    return live.wanted_titles(p.select("title"), cached)


def _image_answer(url: str) -> tuple[int, dict, str]:
    """Answers of all three hops, by the number at the end of a title or of an image's name."""
    asked = parse_qs(urlsplit(url).query)
    name, k = asked["titles"][0], int(re.search(r"(\d+)$", asked["titles"][0])[1])
    if asked["prop"] == ["pageimages"]:
        return (404, {}, "") if k % 7 == 0 else (200, {}, json.dumps({"query": {"pages": {"1": {"original": {"source": f"http://e.com/own{k}"}} if k % 7 == 1 else {}}}}))
    if asked["prop"] == ["images"]:
        names = {2: ["a.SVG 1", f"Site Logo {k}", "icon 1", f"late {k}"], 3: [f"good {k}"], 4: [f"bad {k}", f"good {k}"], 5: [f"none {k}", f"good {k}"], 6: [f"bad {k}", f"x.svg {k}", f"good {k}"]}.get(k % 7, [])
        return (404, {}, "") if k % 14 == 7 else (200, {}, json.dumps({"query": {"pages": {"1": {"images": [{"title": x} for x in names]}}}}))
    if name.startswith("bad"):
        return 404, {}, ""
    return 200, {}, json.dumps({"query": {"pages": {"1": {"imageinfo": [{"url": f"http://e.com/{name.replace(' ', '-')}"}] if name.startswith("good") else [{}]}}}})


@query("""SELECT 't ' || doc_id AS title, CASE WHEN doc_id % 7 = 1 THEN 'http://e.com/own' || doc_id WHEN doc_id % 7 IN (3, 4, 6) THEN 'http://e.com/good-' || doc_id END AS image,
  CASE WHEN doc_id % 7 = 1 THEN 1 WHEN doc_id % 7 IN (3, 4, 6) THEN 3 END AS hop FROM documents""")
def image_lookup(spark, sf_dir):
    """Images of pages by three hops of requests: the page's own, none, no picture among the first three, the first, the next after a failed request, none in an answer."""
    titles = _docs(spark, sf_dir).select(F.concat(F.lit("t "), F.col("doc_id").cast("string")).alias("title"))
    return images.find_images(titles, f"{__name__}:_image_answer", _QUICK)


# ── files in and out ────────────────────────────────────────────────────────


def _written(spark: SparkSession, rendered: DataFrame) -> str:
    root = _folder(spark)
    files.write_files(rendered.select("path", "content"), root)
    return root


@query(_FILES + f" SELECT directory, substr(path, 8) AS path, raw FROM files WHERE directory IN {C.INDEX_DIRS}")
def read_index_dirs(spark, sf_dir):
    """Files written below the shared folder and read back, the index's directories only."""
    root = _written(spark, _files(spark, sf_dir).withColumnRenamed("raw", "content")) + "/output"
    found = files.read_markdown(spark, root)
    return found.select("directory", F.concat_ws("/", "directory", "file_name").alias("path"), "raw")


@query(_FILES + " SELECT directory, substr(path, 8) AS path, raw FROM files")
def read_tree(spark, sf_dir):
    """The same, the whole tree."""
    found = files.read_markdown(spark, _written(spark, _files(spark, sf_dir).withColumnRenamed("raw", "content")), None)
    return found.select("directory", F.concat_ws("/", "directory", "file_name").alias("path"), "raw")


@query(PARSED + """ SELECT row_number() OVER (ORDER BY display_title, page_id) - 1 AS place, display_title AS title, revision_id AS revision FROM parsed WHERE redirect_target IS NULL AND markdown <> ''""")
def index_document(spark, sf_dir):
    """The index written as one array in order, and read back by place."""
    p, path = fx.parsed_pages(spark, sf_dir), f"{_folder(spark)}/index.json"  # scans take names that begin with an underscore for hidden
    entries = render.index_json(p.withColumn("display_title", F.concat("display_title", F.lit("\t"), F.format_string("%012d", "page_id"))))
    files.write_json(entries, "entry", path, F.col("title"))
    found = files.read_json(spark, path, "title string, revision bigint")
    return found.select("place", F.substring_index("value.title", "\t", 1).alias("title"), "value.revision")


@query("SELECT CASE doc_id % 10 WHEN 0 THEN '../x' || doc_id WHEN 1 THEN '/abs' || doc_id WHEN 2 THEN NULL ELSE 'd/' || doc_id || '.md' END AS path, CASE WHEN doc_id % 10 < 3 THEN 'outside' WHEN doc_id % 10 = 3 THEN 'no content' END AS error FROM documents")
def export_results(spark, sf_dir):
    """A batch with bad paths and without contents: each has its error, the others are written."""
    k, i = F.col("doc_id") % 10, F.col("doc_id").cast("string")
    path = F.when(k == 0, F.concat(F.lit("../x"), i)).when(k == 1, F.concat(F.lit("/abs"), i)).when(k != 2, F.concat(F.lit("d/"), i, F.lit(".md")))
    return files.export_files(_docs(spark, sf_dir).select(path.alias("path"), F.when(k != 3, F.col("text")).alias("content")), _folder(spark))


@query(_FILES + " SELECT (SELECT count(*) FROM files) AS n_written, CAST(0 AS BIGINT) AS n_left")
def cleaned_output(spark, sf_dir):
    root = _written(spark, _files(spark, sf_dir).withColumnRenamed("raw", "content"))
    written = materialize(files.read_markdown(spark, root, None).agg(F.count("*").alias("n_written")), "written")
    files.clean_output(spark, f"{root}/output")
    left = files.read_markdown(spark, root, None).agg(F.count("*").alias("n_left"))
    return written.join(F.broadcast(left), F.lit(True))  # one row each


@query(PARSED + " SELECT title, page_id, revision_id, updated, array_to_string(categories, '|') AS categories, wikitext, redirect_target, 'completed' AS status FROM parsed")
def sqlite_pages(spark, sf_dir):
    """The page table through SQLite files, one for each task, and back."""
    root = _folder(spark)
    p = fx.parsed_pages(spark, sf_dir).withColumn("status", F.lit("completed"))
    materialize(sqlite.write_shards(p.drop("markdown"), root), "shards")
    back = sqlite.typed(sqlite.read_shards(spark, root))
    return back.select("title", "page_id", "revision_id", "updated", F.array_join("categories", "|").alias("categories"), "wikitext", "redirect_target", "status")


@query(f"WITH wiki_pages AS ({fx.DUCKDB_PAGES}), {fx.SQL_EDGES}, c AS (SELECT count(DISTINCT title) AS n FROM edges WHERE page_type = 'subcat') SELECT 'categories' AS cached, n AS n_before, CAST(0 AS BIGINT) AS n_after FROM c UNION ALL SELECT 'pages', count(*), 0 FROM wiki_pages")
def cleaned_cache(spark, sf_dir):
    """The cached tables as files, before and after everything is deleted."""
    root = _folder(spark)
    cats = fx.category_edges(spark, sf_dir).where("page_type = 'subcat'").groupBy("title").agg(F.min("parent").alias("parent")).withColumn("crawled", F.lit(True))
    materialize(sqlite.write_shards(cats, root, "categories").unionByName(sqlite.write_shards(fx.wiki_pages(spark, sf_dir).select("title", "wikitext"), root)), "shards")

    def counts(name: str) -> DataFrame:
        parts = [sqlite.read_shards(spark, root, t).agg(F.count("*").alias(name)).select(F.lit(t).alias("cached"), name) for t in ("categories", "pages")]
        return materialize(parts[0].unionByName(parts[1]), name)

    before = counts("n_before")
    materialize(sqlite.remove_shards(spark, root), "removed")
    return before.join(counts("n_after"), "cached")


def _image(url: str) -> tuple[int, dict, bytes]:
    return (404, {}, b"") if url.endswith("gone.png") else (200, {}, url.encode())


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '.png' WHEN 1 THEN '.jpeg' WHEN 2 THEN '.webp' ELSE '.jpg' END AS extension, CASE doc_id % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'failed' WHEN 2 THEN 'exists' ELSE 'stored' END AS outcome FROM documents")
def image_downloads(spark, sf_dir):
    """Images fetched by a client without network: without address, gone, there already, stored."""
    i = F.col("doc_id").cast("string")
    k = F.col("doc_id") % 5
    named = F.when(k == 0, "a.png").when(k == 1, "b.JPEG?x=1").when(k == 2, "c.webp#y").when(k == 3, "d.jpg").otherwise("plain")
    url = F.when(F.col("doc_id") % 4 == 1, "http://e.com/gone.png").when(F.col("doc_id") % 4 != 0, F.concat(F.lit("http://e.com/"), i))
    extension = files.image_extension(F.concat(F.lit("http://e.com/"), named))
    wanted = _docs(spark, sf_dir).select("doc_id", i.alias("title"), extension.alias("extension"), F.concat(F.lit("images/"), i, extension).alias("path"), url.alias("url"))
    root, client = _folder(spark), f"{__name__}:_image"
    materialize(files.download_images(wanted.where("doc_id % 4 = 2"), client, root), "first")
    out = files.download_images(wanted, client, root)
    return wanted.select("doc_id", "title", "extension").join(out.select("title", "outcome"), "title").drop("title")


def _model(request: str) -> str:
    return "" if len(request) % 5 == 0 else f"rewritten from {len(request)} characters"


_REWRITTEN = _FLAWED + f""", c AS (SELECT path, coalesce(front, '') AS front, length(substr(st, 1, {quality.LLM_CHARS})) AS n FROM g WHERE length(st) >= {quality.LLM_LEAST}),
w AS (SELECT path, array_to_string(list_filter(string_split(front, chr(10)), lambda l: NOT regexp_matches(l, '^\\s*-\\s+x\\s*$')), chr(10)) AS front, 'rewritten from ' || n || ' characters' AS body FROM c WHERE n % 5 <> 0)"""


@query(_REWRITTEN + " SELECT path, '---' || chr(10) || ltrim(front, chr(10)) || '---' || chr(10) || chr(10) || body || chr(10) AS content FROM w")
def rewritten_files(spark, sf_dir):
    """Files rewritten by a model (here a stand-in), without some category tags."""
    return files.rewritten_files(files.rewrite(quality.llm_candidates(_flawed_files(spark, sf_dir)), _model), drop_tags=("x",))


@query(_REWRITTEN + " SELECT path, CAST(length(body) AS BIGINT) AS n_chars FROM w")
def rewritten_dry(spark, sf_dir):
    return files.rewritten_files(files.rewrite(quality.llm_candidates(_flawed_files(spark, sf_dir)), _model), dry=True)


@query("""SELECT p AS path, CAST(doc_id % 7 AS BIGINT) AS size, CASE WHEN k = 1 THEN 'ignored' WHEN k IN (0, 3) THEN 'uploadable' ELSE 'review' END AS kind, false AS is_large FROM (SELECT doc_id, doc_id % 5 AS k,
  CASE doc_id % 5 WHEN 0 THEN 'd' || doc_id || '/a.py' WHEN 1 THEN 'd' || doc_id || '/b.db' WHEN 2 THEN 'd' || doc_id || '/notes.md' WHEN 3 THEN 'tools/x' || doc_id || '.sh' ELSE '__pycache__/c' || doc_id || '.pyc' END AS p FROM documents) WHERE k <> 4""")
def release_manifest(spark, sf_dir):
    k, i = F.col("doc_id") % 5, F.col("doc_id").cast("string")
    path = (
        F.when(k == 0, F.concat(F.lit("d"), i, F.lit("/a.py"))).when(k == 1, F.concat(F.lit("d"), i, F.lit("/b.db"))).when(k == 2, F.concat(F.lit("d"), i, F.lit("/notes.md")))
        .when(k == 3, F.concat(F.lit("tools/x"), i, F.lit(".sh"))).otherwise(F.concat(F.lit("__pycache__/c"), i, F.lit(".pyc")))
    )
    root = _written(spark, _docs(spark, sf_dir).select(path.alias("path"), F.repeat(F.lit("x"), (F.col("doc_id") % 7).cast("int")).alias("content")))
    return files.manifest(spark, root)


# ── reports ─────────────────────────────────────────────────────────────────

_TAIL = "\nsee [[A b|c]] [[D]] {{t}} &nbsp;"
_REPORTED = _FLAWED + f""", rf AS (SELECT path, front, has, CAST(path AS BIGINT) AS id, raw || t AS raw, body || t AS body FROM (SELECT *, CASE WHEN CAST(path AS BIGINT) % 14 = 0 THEN {quote(_TAIL)} ELSE '' END AS t FROM f)),
x AS MATERIALIZED (SELECT rf.*, 'n' || (id % 97) AS file_name, 'd' || (id % 5) AS directory, {sql_strip("raw")} = '' AS is_empty, {sql_strip("body")} AS st, length({quality.sql_without_headings("body")}) AS plain,
  {sql_strip("regexp_replace(body, '^#\\s+[^\\n]+\\n?', '')")} AS no_h1, CAST({quality.sql_word_count("body")} AS BIGINT) AS words FROM rf),
k AS (SELECT count(*) AS files, count(*) FILTER (is_empty) AS e, count(*) FILTER (NOT is_empty AND length(no_h1) < 10) AS t, count(*) FILTER (NOT is_empty AND words < 300) AS s FROM x),
same AS (SELECT file_name, count(*) AS n FROM x WHERE NOT is_empty GROUP BY 1 HAVING count(*) > 1), shown AS (SELECT * FROM same ORDER BY file_name LIMIT 30),
dup AS (SELECT count(*) AS g, coalesce(sum(n), 0) AS n FROM (SELECT count(*) AS n FROM x WHERE NOT is_empty GROUP BY body HAVING count(*) > 1)),
res AS (SELECT path, list_filter([{", ".join(f"CASE WHEN regexp_matches(body, {quote(p)}) THEN {quote(n)} END" for n, p in quality.RESIDUE)}], lambda v: v IS NOT NULL) AS found FROM x),
short AS (SELECT path, words FROM x WHERE NOT is_empty AND words < 300 ORDER BY words, path LIMIT 30),
links AS (SELECT path, regexp_extract_all(body, {quote(quality.WIKI_LINK)}, 1) AS l FROM x WHERE NOT is_empty),
near AS (SELECT substr(no_h1, 1, 200) AS fp, count(*) AS n, lpad(CAST(1000000000000 - count(*) AS VARCHAR), 13, '0') || sha256(substr(no_h1, 1, 200)) AS key FROM x WHERE NOT is_empty GROUP BY 1 HAVING count(*) > 1)"""
_LINE = "=" * 60
_BLOCK = f"chr(10) || '{_LINE}'"


def _lines(rows: list[tuple[int, int, str]], source: str) -> str:
    return " UNION ALL ".join(f"SELECT {s} AS section, {p} AS part, '' AS key, {line} AS line FROM {source}" for s, p, line in rows)


_SCAN = _REPORTED + " " + " UNION ALL ".join([
    _lines([
        (0, 0, f"'{_LINE}'"), (0, 1, "'质量报告 - output 目录 Markdown 文件扫描'"), (0, 2, f"'{_LINE}'"), (0, 3, "chr(10) || '总 Markdown 文件数: ' || files"),
        (1, 0, _BLOCK), (1, 1, "'## 1. 空文档 (0 字节或仅空白字符)'"), (1, 2, "'数量: ' || e"), (2, 0, _BLOCK), (2, 1, "'## 2. 仅含标题的文档 (正文 < 10 字符)'"), (2, 2, "'数量: ' || t"),
        (3, 0, _BLOCK), (3, 1, "'## 3. 短文档 (< 300 字)'"), (3, 2, "'数量: ' || s || ' (' || (s * 100 // files) || '%)'"), (3, 3, "chr(10) || '字数分布:'"),
        *((3, 4 + i, f"'  {a}-{b}字: ' || (SELECT count(*) FROM x WHERE NOT is_empty AND words < 300 AND words >= {a} AND words < {b}) || ' 个文件'") for i, (a, b) in enumerate(((0, 10), (10, 50), (50, 100), (100, 200), (200, 300)))),
        (3, 9, "chr(10) || '最短的 30 个文档:'"), (4, 0, _BLOCK), (4, 1, "'## 4. Wiki 残留'"), (4, 2, "'含有 Wiki 残留的文件数: ' || (SELECT count(*) FROM res WHERE len(found) > 0)"),
        (5, 0, _BLOCK), (5, 1, "'## 5. 重复文档'"), (5, 2, "'重复组数量: ' || (SELECT g FROM dup)"), (5, 3, "'涉及文件总数: ' || (SELECT CAST(n AS BIGINT) FROM dup)"),
        (6, 0, "chr(10) || '## 6. 同名文件 (不同目录)'"), (6, 1, "'同名文件组数: ' || (SELECT count(*) FROM same)"), (7, 0, _BLOCK), (7, 1, "'## 7. 子目录分布'"),
    ], "k"),
    "SELECT 1, 3, path, '  - ' || path FROM x WHERE is_empty", "SELECT 2, 3, path, '  - ' || path FROM x WHERE NOT is_empty AND length(no_h1) < 10",
    "SELECT 3, 10, lpad(CAST(words AS VARCHAR), 13, '0') || path, '  [' || words || '字] ' || path FROM short",
    "SELECT 4, 3, path, '  - ' || path || ': [' || array_to_string(list_transform(found, lambda v: '''' || v || ''''), ', ') || ']' FROM res WHERE len(found) > 0",
    "SELECT 6, 2, file_name || chr(0), '  - ' || file_name || ': ' || n || ' 个' FROM shown", "SELECT 6, 2, file_name || chr(0) || path, '      ' || path FROM x JOIN shown USING (file_name) WHERE NOT is_empty",
    "SELECT 6, 3, '', '  ... 还有 ' || (count(*) - 30) || ' 组' FROM same HAVING count(*) > 30", "SELECT 7, 2, directory, '  ' || directory || ': ' || count(*) || ' 个文件' FROM x GROUP BY directory",
])


def _reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flawed files, some with markup left, whose names and directories repeat."""
    f, i = _flawed_files(spark, sf_dir), F.col("path").cast("long")
    raw = F.concat("raw", F.when(i % 14 == 0, _TAIL).otherwise(""))
    return f.select("path", F.concat(F.lit("n"), (i % 97).cast("string")).alias("file_name"), F.concat(F.lit("d"), (i % 5).cast("string")).alias("directory"), raw.alias("raw"))


@query(_SCAN.replace("chr(0)", "'|'"))
def scan_report(spark, sf_dir):
    return reports.scan_report(_reported(spark, sf_dir)).withColumn("key", F.replace("key", F.lit("\x00"), F.lit("|")))


_DEEP = _REPORTED + " " + " UNION ALL ".join([
    _lines([
        (0, 0, f"'{_LINE}'"), (0, 1, "'深度扫描结果'"), (0, 2, f"'{_LINE}'"), (1, 0, "chr(10) || '## A. 空正文文档: ' || (SELECT count(*) FROM x WHERE NOT is_empty AND plain < 5)"),
        (2, 0, f"chr(10) || '## B. 仅含注释的空文档: ' || (SELECT count(*) FROM x WHERE NOT is_empty AND plain < 10 AND regexp_matches(st, {quote(quality.REFERENCE_HEADING)}))"),
        (3, 0, "chr(10) || '## C. Wiki双括号链接: ' || (SELECT count(*) FROM links WHERE len(l) > 0)"),
        (4, 0, f"chr(10) || '## D. Frontmatter问题: ' || (SELECT count(*) FROM x WHERE NOT is_empty AND regexp_matches(coalesce(front, ''), {quote(quality.DANGLING_LOOSE)}))"),
        (5, 0, "chr(10) || '## E. 截断内容: ' || (SELECT count(*) FROM x WHERE NOT is_empty AND regexp_matches(string_split(st, chr(10))[-1], '^#{1,6}\\s+'))"), (6, 0, "chr(10) || '## F. 近似重复组: ' || (SELECT count(*) FROM near)"),
    ], "k"),
    "SELECT 1, 1, path, '  - ' || path FROM x WHERE NOT is_empty AND plain < 5", f"SELECT 2, 1, path, '  - ' || path FROM x WHERE NOT is_empty AND plain < 10 AND regexp_matches(st, {quote(quality.REFERENCE_HEADING)})",
    "SELECT 3, 1, path, '  - ' || path || ': [' || array_to_string(list_transform(l, lambda v: '''' || v || ''''), ', ') || ']' FROM links WHERE len(l) > 0",
    f"SELECT 4, 1, path, '  - ' || path || ': categories末尾有空项' FROM x WHERE NOT is_empty AND regexp_matches(coalesce(front, ''), {quote(quality.DANGLING_LOOSE)})",
    "SELECT 5, 1, path, '  - ' || path || ': ends with heading' FROM x WHERE NOT is_empty AND regexp_matches(string_split(st, chr(10))[-1], '^#{1,6}\\s+')",
    "SELECT 6, 1, key, '  - (' || n || ' files):' FROM near", "SELECT 6, 1, key || path, '      ' || path FROM x JOIN near ON substr(no_h1, 1, 200) = fp WHERE NOT is_empty",
])


@query(_DEEP)
def deep_report(spark, sf_dir):
    return reports.deep_report(_reported(spark, sf_dir))


_DONE = ", l AS (SELECT path, action, fixed, CASE WHEN regexp_extract(st, '(?m)^#\\s+([^\\n]+)', 1) = '' THEN path || '.md' ELSE regexp_extract(st, '(?m)^#\\s+([^\\n]+)', 1) END AS title FROM r), c AS (SELECT count(*) FILTER (fixed) AS a, count(*) FILTER (action = 'delete') AS b, count(*) FILTER (action = 'placeholder') AS d FROM l) "


@query(_REPAIR + _DONE + " UNION ALL ".join([
    _lines([(0, 0, "'自动修复详细报告'"), (0, 1, f"'{_LINE}'"), (1, 0, "'Frontmatter修复: ' || a"), (2, 0, "chr(10) || '删除空页面: ' || b"), (3, 0, "chr(10) || '添加占位符: ' || d"), (4, 0, "chr(10) || '总计: ' || (a + b + d)")], "c"),
    "SELECT 1, 1, path, '  ' || path || ': 移除空的categories条目' FROM l WHERE fixed", "SELECT 2, 1, path, '  ' || path || ': 空注释页: ' || title FROM l WHERE action = 'delete'", "SELECT 3, 1, path, '  ' || path || ': ' || title FROM l WHERE action = 'placeholder'",
]))
def repair_log(spark, sf_dir):
    return reports.repair_log(_flawed_files(spark, sf_dir))


# ── statistics ──────────────────────────────────────────────────────────────


@query(_COUNTERS + """ SELECT CAST(i - 1 AS BIGINT) AS position, ['发现页面', '成功爬取', '跳过（未变更）', '过滤（非内容）', '失败'][i] AS metric, CAST([total_pages, pages_crawled, pages_skipped, pages_filtered, pages_failed][i] AS VARCHAR) AS value FROM k, generate_series(1, 5) t(i)""")
def run_summary(spark, sf_dir):
    return stats.summary(_counters(spark, sf_dir))


@query(_TAGGED + f""", {fx.SQL_EDGES}, k AS (SELECT count(*) AS a, count(*) FILTER (skip_reason IS NULL) AS b, 0::BIGINT AS c, (SELECT count(DISTINCT title) FROM edges WHERE page_type = 'subcat') AS d FROM tagged)
  SELECT CAST(i - 1 AS BIGINT) AS position, ['已缓存页面数', '已完成页面数', '失败页面数', '已发现分类数'][i] AS metric, CAST([a, b, c, d][i] AS VARCHAR) AS value FROM k, generate_series(1, 4) t(i)""")
def cache_summary(spark, sf_dir):
    categories = fx.category_edges(spark, sf_dir).where("page_type = 'subcat'").select("title").distinct()
    return stats.summary(stats.table_counts(filters.tag_pages(fx.wiki_pages(spark, sf_dir)), categories), stats.CACHE_SUMMARY)


@query(_COUNTERS + ", d AS (SELECT count(*) FILTER (redirect_target IS NULL AND trim(markdown) <> '') AS exported_files, count(*) FILTER (redirect_target IS NOT NULL OR trim(markdown) = '') AS skipped_files FROM tagged WHERE skip_reason IS NULL) SELECT k.*, d.* FROM k, d")
def run_document(spark, sf_dir):
    """The statistics document, read back from its JSON."""
    p = materialize(filters.tag_pages(fx.parsed_pages(spark, sf_dir)).where("skip_reason IS NULL").drop("wikitext"), "pages")  # both counts read it
    exported = render.export_counts(p, render.render_files(p, threshold=1 << 30, plain_yaml=True))
    found = stats.run_document(_counters(spark, sf_dir), exported)
    return found.select(F.from_json("json", ", ".join(f"{n} bigint" for n in (*stats.COUNTERS, "exported_files", "skipped_files"))).alias("d")).select("d.*")


# ── answers to commands ─────────────────────────────────────────────────────

ASKED = (("src1 p1", "角色"), ("src2 p", "歌曲"), ("zzzz qqqq", "乐队"), ("the", "角色"), ("  ", "声优"))


def _short_sql(col: str, n: int) -> str:
    return sql_strip(f"replace(substr({fm.sql_clean(col)}, 1, {n}), chr(10), ' ')")


def _list_sql(ranked: str, q: str, bucket: str) -> str:
    """One row (text) of the list of ``ranked`` (rank, title, preview)."""
    item = f"'  ' || rank || '. ' || title || CASE WHEN {_short_sql('preview', 100)} <> '' THEN chr(10) || '     ' || {_short_sql('preview', 100)} ELSE '' END"
    found = f"'🔍 **「{q}」** — 共 ' || count(*) || ' 条结果' || chr(10) || chr(10) || string_agg({item}, chr(10) ORDER BY rank) || chr(10) || chr(10) || '💡 输入 `/角色 xxx` `/歌曲 xxx` 可查看详情'"
    none = quote(f"🔍 搜索 **「{q}」**（{bucket or '全部'} · 本地）\n\n未找到相关结果。\n\n试试：缩短关键词  换用中文/日文  用 `/随机{bucket}` 浏览")
    return f"SELECT CASE WHEN count(*) > 0 THEN {found} ELSE {none} END AS text FROM {ranked}"


def _ranked_sql(name: str, q: str, limit: int, bucket: str = "") -> str:
    where = f"WHERE category_dir = '{bucket}'" if bucket else ""
    return f"{name} AS MATERIALIZED (SELECT row_number() OVER (ORDER BY score DESC, dir_rank, file_name) AS rank, * FROM (SELECT *, {_score_sql(q)} AS score FROM idx {where}) WHERE score > 0 ORDER BY 1 LIMIT {limit})"


def _answers_sql() -> str:
    ctes, rows = [], []
    for n, (q, bucket) in enumerate(ASKED):
        if not q.strip():
            rows.append(f"SELECT {quote(q)} AS asked, 'help' AS mode, {quote(render.HELP)} AS text")
            continue
        ctes.append(_ranked_sql(f"r{n}", q, 5, bucket))
        card = f"{_EMOJI_SQL.replace('directory', 'category_dir')} || ' **' || title || '**' || chr(10) || chr(10) || {_cut_sql('body', 1200, 1000, 1200, 1100)} || chr(10) || chr(10) || '📖 萌娘百科 · 本地知识库'"
        ctes.append(f"c{n} AS (SELECT score >= 20 AS good, {card} AS card FROM (SELECT *, {fm.sql_clean('content')} AS body FROM r{n} WHERE rank = 1))")
        missing = quote(f"未在{bucket}内找到「{q}」\n\n试试 `/萌百搜索 {q}` 或 `/随机{bucket}`")
        rows.append(f"SELECT {quote(q)} AS asked, CASE WHEN c.good THEN 'detail' WHEN c.good IS NULL THEN 'none' ELSE 'list' END AS mode, CASE WHEN c.good THEN c.card WHEN c.good IS NULL THEN {missing} ELSE l.text END AS text FROM ({_list_sql(f'r{n}', q, bucket)}) l LEFT JOIN c{n} c ON true")
    return _INDEX + ", " + ", ".join(ctes) + " " + " UNION ALL ".join(rows)


@query(_answers_sql())
def entry_answers(spark, sf_dir):
    """Cards, lists, help and not-found sentences of the commands for single buckets."""
    idx = materialize(_index(spark, sf_dir), "index")
    parts = [services.entry_query(idx, q, bucket).select(F.lit(q).alias("asked"), "mode", "text") for q, bucket in ASKED]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(_INDEX + ", " + _ranked_sql("r", "p31", 8) + f" SELECT 'list' AS mode, text, '' AS image FROM ({_list_sql('r', 'p31', '')})")
def search_answer(spark, sf_dir):
    return services.search_query(_index(spark, sf_dir), "p31")


@query(_INDEX + " SELECT b AS bucket, CASE WHEN EXISTS (SELECT 1 FROM idx WHERE category_dir = b) THEN 'random' ELSE 'error' END AS mode, true AS is_known FROM (SELECT unnest(['角色', '歌曲', '声优']) AS b)")
def random_answers(spark, sf_dir):
    """A random entry of each bucket: a card of the pool, or the sentence for an empty bucket."""
    idx = materialize(_index(spark, sf_dir), "index")
    out = None
    for bucket, chars in services.RANDOM_COMMANDS.values():
        pool = index.random_pool(idx, bucket).select(render.random_card(F.col("title"), F.col("category_dir"), F.substring("content", 1, chars)).alias("card"))
        answer = materialize(services.random_query(idx, bucket, chars), "answer")
        known = answer.join(pool, F.col("text") == F.col("card"), "left_semi").agg((F.count("*") > 0).alias("found"))
        row = answer.join(F.broadcast(known), F.lit(True)).select(F.lit(bucket).alias("bucket"), "mode", (F.col("found") | (F.col("text") == render.error_text(f"{bucket}库为空"))).alias("is_known"))  # one row each
        out = row if out is None else out.unionByName(row)
    return out


_MESSAGES = ("/角色 {}", " 角色{}", "歌曲", "/乐队  {} ", "萌百搜索 {}", "/萌百搜索 ", "随机歌曲{}", "/随机声优", "/bandori", "{}", "//角色 {}")
_ASKED = (("entry", "角色", True), ("entry", "角色", True), ("help", "歌曲", False), ("entry", "乐队", True), ("search", "萌百搜索", True), ("help", "萌百搜索", False), ("random", "随机歌曲", True), ("random", "随机声优", False), ("help", "bandori", False), ("help", "", None), ("help", "", None))


@query(
    PARSED
    + " SELECT page_id, CASE page_id % 11 "
    + " ".join(f"WHEN {i} THEN {quote(c)}" for i, (_, c, _) in enumerate(_ASKED))
    + " END AS command, CASE page_id % 11 "
    + " ".join(f"WHEN {i} THEN {quote(k)}" for i, (k, _, _) in enumerate(_ASKED))
    + " END AS kind, CASE WHEN page_id % 11 IN ("
    + ", ".join(str(i) for i, x in enumerate(_ASKED) if x[2])
    + ") THEN title ELSE '' END AS argument FROM parsed"
)
def command_modes(spark, sf_dir):
    """What chat messages made of the pages' titles ask for."""
    t, said = F.col("title"), F.lit("")
    for i, m in enumerate(_MESSAGES):
        before, _, after = m.partition("{}")
        said = F.when(F.col("page_id") % len(_MESSAGES) == i, F.concat(F.lit(before), t, F.lit(after)) if "{}" in m else F.lit(m)).otherwise(said)
    return fx.wiki_pages(spark, sf_dir).select("page_id", services.dispatch(said).alias("asked")).select("page_id", "asked.command", "asked.kind", "asked.argument")


@query("SELECT 'm' AS mode, 't' || doc_id AS text, CASE WHEN doc_id % 3 = 0 THEN 'i' || doc_id ELSE '' END AS image, doc_id % 3 <> 0 AS is_plain FROM documents")
def answer_messages(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", F.lit("m").alias("mode"), F.concat(F.lit("t"), F.col("doc_id").cast("string")).alias("text"), F.concat(F.lit("i"), F.col("doc_id").cast("string")).alias("image"))
    return services.messages(d, d.where("doc_id % 3 = 0").select(F.col("image").alias("path")))


@query(PARSED + " SELECT page_id, title AS argument FROM parsed")
def command_arguments(spark, sf_dir):
    t, k = F.col("title"), F.col("page_id") % 4
    said = F.when(k == 0, F.concat(F.lit("/角色 "), t)).when(k == 1, F.concat(F.lit(" 角色"), t)).when(k == 2, F.concat(F.lit("  "), t, F.lit("\t"))).otherwise(F.concat(F.lit("/"), t))
    return fx.wiki_pages(spark, sf_dir).select("page_id", names.command_argument(said, "角色").alias("argument"))
