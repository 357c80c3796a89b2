"""Names, filters, search, cards, merges, repair, files: worked examples."""

import datetime
import json

import pytest
import yaml
from pyspark.sql import functions as F

from quernstone import config as C
from quernstone import queries
from quernstone.functions import frontmatter as fm
from quernstone.functions import names
from quernstone.operators import filters, graph, index, merge, quality, render, stats
from quernstone.plans import live
from quernstone.services import Engine
from quernstone.sources import api, files, listing


def one(spark, f, *values):
    kinds = ", ".join(f"c{i} {'array<string>' if isinstance(v, list) else 'string'}" for i, v in enumerate(values))
    return spark.createDataFrame([tuple(values)], kinds).select(f(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first()[0]


@pytest.mark.parametrize(
    "name, expected",
    [("千早爱音", "千早爱音"), ('a\\b/c:d*e?f"g<h>i|j', "a_b_c_d_e_f_g_h_i_j"), ("a   b", "a_b"), ("a...", "a"), ("", "unnamed"), ("a" * 300, "a" * 200), ("é", "é"), ("__x__", "x"), ("a　b", "a_b")],
)
def test_sanitize(spark, name, expected):
    assert one(spark, names.sanitize_filename, name) == expected


def test_names(spark):
    assert one(spark, names.display_title, "Category:Help:x") == "x"
    assert one(spark, names.strip_namespace, "Category:Help:x") == "Help:x"
    assert one(spark, names.normalize_category, "x") == "Category:x"
    assert one(spark, names.page_url, "a b/*~é+") == C.BASE_URL + "/a%20b%2F%2A~%C3%A9%2B"
    assert one(spark, names.url_to_title, "http://h/a+b%20c") == "a+b c"
    assert one(spark, lambda t: names.truncate(t, 10), "x" * 11) == "x" * 7 + "..."
    assert one(spark, lambda t: names.truncate(t, 10), "x" * 10) == "x" * 10
    assert one(spark, names.short_date, "2026-07-01T10:00:00Z") == "2026-07-01"
    assert one(spark, names.short_date, "about 2026 or so") == "about 2026"
    assert one(spark, names.short_date, None) is None
    assert one(spark, lambda m: names.command_argument(m, "角色"), " /角色  名字 ") == "名字"
    assert one(spark, lambda t: names.output_path(t, F.lit("角色"), "out", F.lit("_1")), "a b") == "out/角色/a_b_1.md"


@pytest.mark.parametrize(
    "categories, expected",
    [(["BanG Dream!角色"], "角色"), (["歌曲"], "歌曲"), (["x乐队"], "乐队"), (["未知"], "其它"), ([], "其它"), (["未知", "人物"], "角色"), (["动漫"], "动画"), (["专辑"], "专辑"), (["演唱会"], "Live"), (["歌曲", "角色"], "歌曲")],
)
def test_directory(spark, categories, expected):
    assert one(spark, filters.directory_of, categories) == expected


@pytest.mark.parametrize(
    "title, cats, text, expected",
    [
        ("Category:x", [], "t", "命名空间前缀: Category:"),
        ("x/模板", [], "t", "标题关键字: /模板"),
        ("x/ 列表", [], "t", "标题匹配正则"),
        ("x", ["a", "y沙盒"], "t", "分类标签: y沙盒"),
        ("x", [], "", "空页面"),
        ("x", [], None, "空页面"),
        ("x", [], "Redirect to: y", "重定向页"),
        ("x", [], "a{{Disambig}}", "内容模式: {{Disambig"),
        ("x", [], "a" * 500 + "{{navbox", None),
        ("x", ["角色"], "t", None),
    ],
)
def test_filters(spark, title, cats, text, expected):
    rows = spark.createDataFrame([(title, cats, text)], "t string, c array<string>, w string")
    assert rows.select(filters.skip_reason(F.col("t"), F.col("c"), F.col("w"))).first()[0] == expected


LONG = "preview that is longer than thirty characters"


@pytest.mark.parametrize(
    "title, cats, preview, query, expected",
    [
        ("abc", [], LONG, "ABC ", 100),
        ("abc", [], "short", "abc", 60),
        ("abcd", [], LONG, "abc", 80),
        ("abc简介", [], LONG, "abc", 90),
        ("xabx", [], LONG, "ab", 70),
        ("xabx", [], "short", "ab", 30),
        ("t", ["some ABC"], LONG, "abc", 30),
        ("t", ["some ABC"], "short", "abc", 0),
        ("t", [], LONG + " abc", "abc", 15),
        ("xaby", [], LONG, "abca", 19),
        ("zzz", [], LONG, "q", 0),
    ],
)
def test_score(spark, title, cats, preview, query, expected):
    rows = spark.createDataFrame([(title, cats, preview)], "t string, c array<string>, p string")
    assert rows.select(index.score(F.col("t"), F.col("c"), F.col("p"), query)).first()[0] == expected


def _file(title, body, cats=("x",), directory="角色"):
    front = yaml.dump({"title": title, "categories": list(cats)}, allow_unicode=True, sort_keys=False)
    return (f"kb/{directory}/{title}.md", directory, f"{title}.md", f"---\n{front}---\n\n# {title}\n\n{body}\n")


def test_index_and_services(spark):
    rows = [_file("alpha", "word " * 60), _file("alpha two", "other " * 60), _file("beta", "b", directory="动画"), _file("gone", "b", directory="专辑")]
    entries = index.build_index(spark.createDataFrame(rows, "path string, directory string, file_name string, raw string"))
    assert sorted((r["title"], r["category_dir"]) for r in entries.collect()) == [("alpha", "角色"), ("alpha two", "角色"), ("beta", "其它")]
    assert {r["category_dir"]: r["entries"] for r in index.bucket_counts(entries).collect()} == {"角色": 2, "歌曲": 0, "乐队": 0, "声优": 0, "其它": 1}
    engine = Engine(entries)
    assert engine.ask("/角色 alpha")[0] == "detail" and "🎤 **alpha**" in engine.ask("/角色 alpha")[1]
    assert engine.ask("角色 qqqq")[0] == "none"
    assert engine.ask("/角色")[0] == "help"
    assert engine.ask("/萌百搜索 alpha")[1].startswith("🔍 **「alpha」** — 共 2 条结果\n\n  1. alpha\n")
    assert engine.ask("/随机角色", seed=1)[0] == "random"
    assert engine.ask("/随机歌曲")[1] == "⚠️ 歌曲库为空"
    assert Engine(None).ask("x")[0] == "error"
    assert index.search(entries, "  ").count() == 0 and index.search(entries, "alpha", "nowhere").count() == 0


def test_cards(spark):
    body = "x" * 1150 + "。" + "y" * 300
    assert one(spark, lambda c: render.detail_card(F.lit("T"), F.lit("角色"), c), body) == "🎤 **T**\n\n" + "x" * 1150 + "…\n\n📖 萌娘百科 · 本地知识库"
    assert "x" * 600 + "…" in one(spark, lambda c: render.random_card(F.lit("T"), F.lit("q"), c), "x" * 800)
    assert "x" * 600 + "…" in one(spark, lambda c: render.random_card(F.lit("T"), F.lit("q"), c), "x" * 600 + "\n" + "y" * 105)


def test_front_matter(spark):
    raw = "---\ntitle: a\nrevision: 5\nupdated: 2026-07-01\ncategories:\n- x\n- 3\n---\n\n# a\n\nbody"
    s = one(spark, lambda r: fm.parse(fm.split_file(r)["front"]), raw)
    assert (s["title"], s["revision"], s["updated"], s["categories"]) == ("a", 5, "2026-07-01", ["x", "3"])
    assert one(spark, lambda r: fm.parse(fm.split_file(r)["front"]), "---\n: [\n---\nx")["title"] is None
    assert one(spark, lambda r: fm.split_file(r)["body"], "--- no end") == "--- no end"
    out = one(spark, lambda t, c: fm.dump(t, F.lit("u"), F.lit(0).cast("long"), F.lit("2026-07-01"), c), "a: b", ["x", "是"])
    assert yaml.safe_load(out) == {"title": "a: b", "url": "u", "updated": "2026-07-01", "categories": ["x", "是"]}


def test_render_and_write(spark, tmp_path):
    page = ("Help:千早", "千早", "u", 5, datetime.datetime(2026, 7, 1), ["角色"], None, "## A\n\nx")
    schema = "title string, display_title string, url string, revision_id long, updated timestamp, categories array<string>, redirect_target string, markdown string"
    pages = spark.createDataFrame([page, ("r", "r", "u", 1, None, ["角色"], "x", "text"), ("e", "e", "u", 1, None, [], None, "  ")], schema)
    out = render.render_files(pages, root="out")
    rows = out.collect()
    assert [r["path"] for r in rows] == ["out/角色/千早.md"]
    assert rows[0]["content"] == "---\ntitle: 千早\nurl: u\nrevision: 5\nupdated: '2026-07-01'\ncategories:\n- 角色\n---\n\n# 千早\n\n## A\n\nx\n"
    files.write_files(out, str(tmp_path))
    back = files.read_markdown(spark, f"{tmp_path}/out").collect()
    assert [(r["directory"], r["file_name"], r["raw"]) for r in back] == [("角色", "千早.md", rows[0]["content"])]
    assert files.read_markdown(spark, str(tmp_path), None).count() == 1
    with pytest.raises(FileNotFoundError):
        files.read_markdown(spark, f"{tmp_path}/nowhere")
    assert render.export_counts(pages, out).first() == (1, 2)
    kinds = {r["path"]: r["kind"] for r in files.manifest(spark, str(tmp_path)).collect()}
    assert kinds == {"out/角色/千早.md": "review"}
    files.clean_output(spark, f"{tmp_path}/out")
    assert not (tmp_path / "out").exists()


def test_upsert_is_idempotent_and_nulls_win(spark):
    now = F.lit("2026-02-02").cast("timestamp")
    old = spark.sql("SELECT 'a' title, 1L v, timestamp'2026-01-01' created_at, timestamp'2026-01-01' updated_at UNION ALL SELECT 'b', 2L, timestamp'2026-01-01', timestamp'2026-01-01'")
    new = spark.sql("SELECT 'a' title, CAST(NULL AS BIGINT) v UNION ALL SELECT 'c', 3L")
    once = merge.upsert(old, new, "title", now)
    rows = {r["title"]: (r["v"], str(r["created_at"])[:10], str(r["updated_at"])[:10]) for r in once.collect()}
    assert rows == {"a": (None, "2026-01-01", "2026-02-02"), "b": (2, "2026-01-01", "2026-01-01"), "c": (3, "2026-02-02", "2026-02-02")}
    assert sorted(map(str, merge.upsert(once, new, "title", now).collect())) == sorted(map(str, once.collect()))


def test_discovery_stops_at_depth_and_cycles(spark):
    edges = spark.createDataFrame([("r", "c1", "subcat"), ("c1", "c2", "subcat"), ("c2", "r", "subcat"), ("c1", "p", "page"), ("c2", "p", "page"), ("c2", "q", "page")], "parent string, title string, page_type string")
    rows = {r["title"]: r["depth"] for r in graph.discover(edges, "r").collect()}
    assert rows == {"r": 0, "c1": 1, "c2": 2, "p": 1, "q": 2}
    assert "q" not in {r["title"] for r in graph.discover(edges, "r", max_depth=1).collect()}


def test_stats(spark):
    k = spark.createDataFrame([(100, 90, 3, 4, 5, datetime.datetime(2026, 7, 1, 10), datetime.datetime(2026, 7, 1, 11))], "total_pages long, pages_crawled long, pages_failed long, pages_skipped long, pages_filtered long, start_time timestamp, end_time timestamp")
    assert stats.with_rates(k).first()[-2:] == (3600.0, 0.02)
    assert stats.with_rates(k.withColumn("start_time", F.lit(None).cast("timestamp"))).first()[-2:] == (0.0, 0.0)
    back = stats.from_key_values(stats.to_key_values(k)).first().asDict()
    assert back == {"total_pages": 100, "pages_crawled": 90, "pages_failed": 3, "pages_skipped": 4}
    assert stats.from_key_values(stats.to_key_values(k), strict=False).first()["pages_filtered"] == 5


def test_quality(spark):
    assert one(spark, quality.word_count, "# T\n\n中文かな two words `code` | x") == 8
    assert one(spark, quality.word_count, "![alt](u) [t](u)") == 2
    assert quality.short_percent(quality.file_metrics(spark.createDataFrame([], "path string, file_name string, directory string, raw string"))).first() == (0, 0, None)
    rows = spark.createDataFrame([("p", "f", "d", "---\ncategories:\n- \n---\n# T\n")], "path string, file_name string, directory string, raw string")
    r = quality.repair(rows).first()
    assert (r["action"], r["fixed_dashes"]) == ("placeholder", True)
    assert r["repaired"] == "---\ncategories:\n---\n# T\n\n> ⚠️ 此页面内容待补充。\n"


def test_listing(spark):
    html = '<div id="mw-subcategories"><a title="Category:S &amp; T">s</a></div><div id="mw-pages"><ul><li><a title="P" href="/P">P</a> <a title="no">x</a></li><li><a title="User:x">x</a></li><li><a title="消歧义 x">x</a></li></ul></div><a href="/Category:R?pagefrom=Q+1">下一页</a>'
    rows = listing.members(spark.createDataFrame([("R", html)], "category string, html string")).collect()
    assert [(r["title"], r["page_type"]) for r in rows] == [("Category:S & T", "subcat"), ("P", "page")]
    assert one(spark, listing.next_url, html) == C.BASE_URL + "/Category:R?pagefrom=Q+1"
    assert one(spark, lambda h: listing.page_from(listing.next_url(h)), html) == "Q 1"
    assert one(spark, listing.next_url, "<a href='x'>y</a>") is None


def fake_client(url):
    return (200, {}, f"body of {url}") if not url.endswith("missing") else (404, {}, "")


def test_api(spark):
    answers = [(429, {"Retry-After": "2"}, ""), (503, {}, ""), (200, {}, "ok")]
    waits = []
    assert api.with_retries(lambda u: answers.pop(0), "u", sleep=waits.append) == (200, "ok")
    assert len(waits) == 2 and waits[0] >= 2
    assert api.with_retries(lambda u: (500, {}, "no"), "u", sleep=lambda s: None)[0] == 500
    now = [0.0]
    limiter = api.Limiter(1.0, 0.0, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    limiter.wait()
    assert limiter.wait() == 1.0
    pages = {"u1": ([{"t": 1}], "/x?pagefrom=b"), "u2": ([{"t": 2}], None)}
    seen = []

    def get(url):
        seen.append(url)
        return 200, {}, "u1" if len(seen) == 1 else "u2"

    assert [m["t"] for m in api.listing_members(get, "Category:A b", parse=lambda t: pages[t])] == [1, 2]
    assert seen == [C.BASE_URL + "/Category:A_b", C.BASE_URL + "/Category:A_b?pagefrom=b"]
    out = api.fetch(spark, ["a", "b", "missing"], "tests.test_operators:fake_client", gap=0, jitter=0, concurrent=2)
    assert sorted((r["url"], r["outcome"]) for r in out.collect()) == [("a", "ok"), ("b", "ok"), ("missing", "http_error")]
    assert one(spark, lambda b: api.classify(F.lit(200), b), "x未授权操作") == "auth_page"
    assert one(spark, api.api_error, '{"error": {"code": "missingtitle"}}') is None
    assert one(spark, api.api_error, '{"error": {"code": "bad"}}') == "bad"


def test_waits(spark):
    now = datetime.datetime(2026, 1, 1, 10, tzinfo=datetime.timezone.utc)
    assert [api.retry_after(x, now) for x in ("3", "Thu, 01 Jan 2026 10:00:09 GMT", "Thu, 01 Jan 2026 09:00:00 GMT", "soon", "", None)] == [3.0, 9.0, 0.0, api.RETRY_AFTER, api.RETRY_AFTER, api.RETRY_AFTER]
    waits, answers = [], [(429, {"Retry-After": "Thu, 01 Jan 1970 00:00:00 GMT"}, ""), (200, {}, "a"), (503, {}, ""), (200, {}, "b")]
    pages = {"a": ([1], "/x?pagefrom=q"), "b": ([2], None)}
    limiter = api.Limiter(7.0, 0.0, clock=lambda: 0.0, sleep=waits.append)
    assert list(api.listing_members(lambda u: answers.pop(0), "Category:A", parse=lambda t: pages[t], sleep=waits.append, limiter=limiter)) == [1, 2]
    assert waits.count(7.0) == 3 and len(waits) == 5  # a gap before each request but the first, a pause after each failure


def test_files_stay_inside(spark, tmp_path):
    for bad in ("../a", "/etc/a", "a/../../b", "", None):
        with pytest.raises(ValueError):
            files.put(str(tmp_path / "root"), bad, "x")
    files.put(f"file://{tmp_path}/root", "d/a.txt", "one")
    files.put(str(tmp_path / "root"), "./d//a.txt", "two")
    assert [str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file()] == ["root/d/a.txt"] and (tmp_path / "root/d/a.txt").read_text() == "two"


def test_crawl_by_command_line(spark, tmp_path, monkeypatch):
    from quernstone import __main__ as cli

    settings = C.Settings(rate_limit=0, jitter=0, strict=False, output_dir=str(tmp_path / "out"))
    cache, client = str(tmp_path / "cache"), "tests.offline:wiki"
    shown = {r["metric"]: r["value"] for r in cli.crawl(spark, client, cache, settings).collect()}
    assert (shown["成功爬取"], shown["失败"]) == ("11", "1")
    assert sorted(p.name for p in (tmp_path / "out/乐队").iterdir()) == [f"Band_{i}.md" for i in range(7)] + ["Overview.md"]
    assert "About Band 1." in (tmp_path / "out/乐队/Band_1.md").read_text()
    assert json.loads((tmp_path / "out/_crawl_stats.json").read_text())["exported_files"] == 11
    assert [x["title"] for x in json.loads((tmp_path / "out/_index.json").read_text())] == sorted([f"Band {i}" for i in range(7)] + ["Overview", "Song 0", "Song 1", "Song 2"])
    assert {(r["title"], r["error"]) for r in cli.cached_pages(spark, cache).where("status = 'failed'").collect()} == {("Song 3", "missing")}
    assert {r["action"]: r["n_pages"] for r in cli.update(spark, client, cache, settings).collect()} == {"unchanged": 11}
    pages = cli.cached_pages(spark, cache)
    assert pages.count() == 12
    stop = live.Interrupt()
    stop()
    again = live.run_crawl(spark, client, settings, cache, stop)
    assert again.pages.count() == 12 and again.pages.where("status = 'completed'").count() == 11
    with pytest.raises(SystemExit):
        stop()


def test_scratch_tables_go(spark):
    from quernstone import storage

    with storage.scratch(spark) as outer:
        with storage.scratch(spark) as keep:
            gone = storage.materialize(spark.range(3), "gone")
            kept = keep(storage.materialize(spark.range(4), "kept"))
        assert kept.count() == 4
        last = outer(storage.materialize(kept, "last"))
    assert last.count() == 4
    for df in (gone, kept):
        with pytest.raises(Exception, match="(?s)FILE_NOT_EXIST|does not exist|No such file"):
            df.collect()


def test_rewrite(spark):
    rows = spark.createDataFrame([("a", "\nt: 1\n", "ask"), ("b", "", "no")], "path string, front string, request string")
    out = files.rewritten_files(files.rewrite(rows, lambda r: "new" if r == "ask" else "")).collect()
    assert [(r["path"], r["content"]) for r in out] == [("a", "---\nt: 1\n---\n\nnew\n")]


def test_config(tmp_path):
    s = C.from_env({"KB_RATE_LIMIT": "2", "KB_HTTP2": "No", "KB_MAX_CONCURRENT": "7", "KB_LOG_LEVEL": "debug", "KB_OUTPUT_DIR": ""})
    assert (s.rate_limit, s.http2, s.max_concurrent, s.log_level, s.output_dir) == (2.0, False, 7, "DEBUG", "output")
    assert C.resolve_kb_path("", {"KB_PATH": str(tmp_path)}) == str(tmp_path)
    assert C.resolve_kb_path("nowhere", {}, exists=lambda p: False) == ""


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    from quernstone.plans import fixtures as fx
    from quernstone.plans.crawl import PAGE_COLUMNS, process, update
    from quernstone.sources.pagetable import PageTable
    from quernstone.streaming import start_updates

    p = fx.parsed_pages(spark, sf_dir).drop("markdown", "display_title")
    day = F.lit("2026-01-01").cast("timestamp")
    cached = process(p).select(*PAGE_COLUMNS, day.alias("created_at"), day.alias("updated_at"))
    fresh = p.where("page_id % 11 <> 0").withColumn("revision_id", F.col("revision_id") + F.when(F.col("page_id") % 3 == 0, 7).otherwise(0))
    PageTable(spark, f"{tmp_path}/table").replace(cached)
    fresh.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(fresh.schema).parquet(f"{tmp_path}/in")
    start_updates(stream, f"{tmp_path}/table", f"{tmp_path}/state").awaitTermination(120)
    merged = PageTable(spark, f"{tmp_path}/table").read().drop("updated_at")
    batch, _ = update(cached, fresh, F.current_timestamp())
    assert sorted(map(str, merged.collect())) == sorted(map(str, batch.select(*merged.columns).collect()))


def test_sqlite_round_trip(spark, tmp_path):
    from quernstone.sources import sqlite

    path = f"{tmp_path}/pages.db"
    pages = spark.createDataFrame([(f"t{i}", i, i, datetime.datetime(2026, 7, 1), ["角色", "x"], "w", None, "u", None, "completed", None) for i in range(20)], "title string, page_id long, revision_id long, updated timestamp, categories array<string>, wikitext string, markdown string, url string, redirect_target string, status string, error string")
    assert sqlite.write_pages(pages, path) == 20
    back = sqlite.read_pages(spark, path, 3)
    assert sorted(map(str, back.select(*pages.columns).collect())) == sorted(map(str, pages.collect()))
    sqlite.write_pages(pages.where("page_id < 3").withColumn("status", F.lit("failed")), path)
    assert {r["status"]: r["n_pages"] for r in stats.status_counts(sqlite.read_pages(spark, path)).collect()} == {"completed": 17, "failed": 3}
    sqlite.clean(path)
    assert sqlite.read_pages(spark, path).count() == 0


def test_python_runs_once_for_each_value(spark, sf_dir):
    """A search parses front matter once and names each page once; the bucket is picked before any of it is parsed."""
    plan = queries.search_bucket(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2 and plan.count("parse(") == plan.count("_nfc(") == 1
    lines = plan.split("\n")
    assert next(i for i, x in enumerate(lines) if "Filter" in x and "角色" in x) > next(i for i, x in enumerate(lines) if "parse(" in x)
