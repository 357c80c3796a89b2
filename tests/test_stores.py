"""The page table, the stored index, fetching at one rate, in waves, and listings with empty files."""

import json
import os
import re
import signal
import threading
import time
from collections import Counter
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from quernstone import config as C
from quernstone.operators import index, merge, postings
from quernstone.plans import fixtures as fx
from quernstone.plans import live
from quernstone.sources import api, files
from quernstone.sources.pagetable import PageTable
from quernstone.storage import Manifests

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ── the page table ──────────────────────────────────────────────────────────


def pages_of(spark, titles, status="completed", revision=1):
    rows = spark.createDataFrame([(t, revision, status) for t in titles], "title string, revision_id long, status string")
    return rows.withColumns({c: F.lit("2026-01-01").cast("timestamp") for c in ("created_at", "updated_at")})


def upsert(old, new):
    return merge.upsert(old, new, "title", F.lit("2026-02-02").cast("timestamp"))


def test_a_merge_rewrites_touched_buckets_only(spark, tmp_path):
    table = PageTable(spark, str(tmp_path))
    titles = [f"t{i}" for i in range(400)]
    table.replace(pages_of(spark, titles))
    changes = spark.createDataFrame([(f"t{i}", 2, "failed") for i in range(9)] + [("new", 1, "pending")], "title string, revision_id long, status string")
    assert table.merge(changes, upsert) == 1
    old, new = Manifests(spark, str(tmp_path)).read(0)["buckets"], Manifests(spark, str(tmp_path)).read(1)["buckets"]
    assert 1 <= sum(old.get(b) != v for b, v in new.items()) <= 10
    rows = {r["title"]: (r["revision_id"], r["status"]) for r in table.read().collect()}
    assert len(rows) == 401 and rows["t3"] == (2, "failed") and rows["t9"] == (1, "completed") and rows["new"] == (1, "pending")
    assert {r["status"] for r in table.read(0).collect()} == {"completed"}
    assert {r["title"] for r in table.by_status("failed").collect()} == {f"t{i}" for i in range(9)}


def test_look_ups_read_one_bucket_and_one_status(spark, tmp_path):
    table = PageTable(spark, str(tmp_path))
    table.replace(pages_of(spark, [f"t{i}" for i in range(300)] + ["中文 title", None]))
    assert len({re.search(r"table_bucket=(\d+)", f)[1] for f in table.get("中文 title").inputFiles()}) == 1
    assert table.get("中文 title").count() == 1 and table.get("nowhere").count() == 0
    assert table.revision("t5").first()[0] == 1 and table.revision("nowhere").first()[0] == 0
    assert re.search(r"PartitionFilters: \[.*status.* = failed", plan(table.by_status("failed"))) and table.by_status("failed").count() == 0
    assert table.read().where("title IS NULL").count() == 1


def test_a_killed_merge_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = PageTable(spark, str(tmp_path))
    table.replace(pages_of(spark, ["a", "b"]))
    changes = spark.createDataFrame([("a", 5, "completed")], "title string, revision_id long, status string")
    with monkeypatch.context() as m:
        m.setattr(Manifests, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            table.merge(changes, upsert)
    assert {r["revision_id"] for r in table.read().collect()} == {1} and table.versions() == [0]
    table.merge(changes, upsert)
    assert {r["title"]: r["revision_id"] for r in table.read().collect()} == {"a": 5, "b": 1}


def test_versions_are_given_once_and_batches_merged_once(spark, tmp_path):
    table = PageTable(spark, str(tmp_path))
    table.replace(pages_of(spark, ["a"]))
    with pytest.raises(FileExistsError):
        Manifests(spark, str(tmp_path)).publish(0, {})
    one = spark.createDataFrame([("a", 7, "completed")], "title string, revision_id long, status string")
    assert [table.merge(one, upsert, b) for b in (0, 0, 1)] == [1, 1, 2]
    assert table.merge(one.limit(0), upsert) == 2
    for i in range(4):
        table.merge(one.withColumn("revision_id", F.lit(10 + i).cast("long")), upsert)
    table.remove_old(2)
    assert len(table.versions()) == 2 and table.read().first()["revision_id"] == 13
    assert len([d for d in os.listdir(tmp_path / "data") if d.startswith("table_version")]) == 2


def test_a_bucket_that_loses_all_its_rows(spark, tmp_path):
    table = PageTable(spark, str(tmp_path))
    table.replace(pages_of(spark, ["a"]), buckets=1)
    table.merge(pages_of(spark, ["a"]), lambda old, new: old.where("false"))
    assert table.read().count() == 0


# ── the stored index ────────────────────────────────────────────────────────


def entries(spark, rows):
    cols = "title string, filepath string, categories array<string>, preview string, category_dir string, image string, dir_rank int, file_name string, content string"
    return spark.createDataFrame([(t, f"p{i}", c, p, d, "", 1, f"f{i:05d}", "x") for i, (t, c, p, d) in enumerate(rows)], cols)


def found(df):
    return [tuple(r) for r in df.select("rank", "filepath", "score").orderBy("rank").collect()]


def test_stored_search_finds_what_a_scan_finds(spark, tmp_path):
    import random

    rng = random.Random(2)
    letters = "abcdé中文简介 IK"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    rows = [(text(rng.randrange(0, 9)), [text(3) for _ in range(rng.randrange(3))], text(rng.choice([0, 10, 40, 80])), rng.choice(["角色", "歌曲", "其它"])) for _ in range(300)]
    whole = entries(spark, rows + [(None, None, None, "角色")])
    assert postings.build(whole, str(tmp_path)) == 0
    stored = postings.StoredIndex(spark, str(tmp_path))
    for q in ["a", "É", "简介", "abc", " dé ", "ik", "acbd", ""]:
        for bucket in ("", "角色"):
            assert found(stored.search(q, bucket, 7)) == found(index.search(whole, q, bucket, 7)), (q, bucket)
    for t in ("ab", rows[0][0], "nowhere"):
        assert stored.get_by_title(t).collect() == index.get_by_title(whole, t).drop("entry").collect()


def test_posting_lists_are_those_of_plain_python(spark):
    """Every token of every entry, each once, in lists of a chunk's entries in order; entries are grouped, not tokens."""
    rows = [("Abba", ["Xy", None, ""], "ab\U0001f3b8b", "角色"), ("", None, None, "角色"), (None, [], "b", "歌曲"), ("简介", ["简"], "", "角色"), ("abba", ["q"], "\x00z", "角色"), ("İ", ["é"], "Ab\nb", "其它")]
    whole = entries(spark, rows).coalesce(1).withColumn("entry", F.monotonically_increasing_id() + 5)
    expected = {}
    for entry, (title, categories, preview, directory) in enumerate(whole.select(F.lower("title"), F.transform("categories", F.lower), F.lower("preview"), "category_dir").collect(), 5):
        title, fields = title or "", [title or "", preview or "", *(c or "" for c in categories or [])]
        tokens = {postings.TITLE + title} | {postings.TITLE_LETTER + c for c in title}
        tokens |= {postings.LETTER + c for f in fields for c in f} | {postings.PAIR + f[i : i + 2] for f in fields for i in range(len(f) - 1)}
        for t in tokens:
            expected.setdefault((t, directory, entry // 3), []).append(entry)
    made = postings.postings_of(whole, 3)
    got = [(r["token"], r["category_dir"], r["chunk"], r["entries"], r["folder"]) for r in made.collect()]
    assert sorted(got) == sorted((*k, v, postings.folder_of(k[0])) for k, v in expected.items())
    assert "token" not in "".join(re.findall(r"hashpartitioning\([^)]*\)", plan(made))) and "explode" not in plan(made)


def test_a_search_reads_folders_of_its_tokens_and_candidates(spark, tmp_path):
    whole = entries(spark, [(f"title {i}", ["c"], "p" * 40, "角色") for i in range(500)] + [("Q9 zy", ["c"], "p" * 40, "角色")])
    postings.build(whole, str(tmp_path))
    stored = postings.StoredIndex(spark, str(tmp_path))
    scan = stored.postings([postings.PAIR + "zy"])
    assert re.search(r"PartitionFilters: \[.*folder", plan(scan)) and re.search(r"PushedFilters: \[.*token", plan(scan)) and scan.count() == 1
    hit = stored.search("q9 zy")
    assert len({re.search(r"part=(\d+)", f)[1] for f in hit.inputFiles() if "/entries/" in f}) >= 1
    assert re.search(r"PartitionFilters: \[.*part.* = ", plan(hit)) and [r["title"] for r in hit.collect()] == ["Q9 zy"]


def test_a_task_writes_neighbours_into_one_folder(spark, tmp_path):
    """A few chunks of entries make a few files, not one in each folder."""
    whole = entries(spark, [(f"title {i}", ["c"], "p" * 40, "角色") for i in range(300)]).coalesce(1)
    postings.build(whole, str(tmp_path))
    stored = postings.StoredIndex(spark, str(tmp_path))
    assert len(stored.entries().inputFiles()) == 1 and stored.entries().count() == 300
    assert stored.get_by_title("Title 7").first()["title"] == "title 7" and stored.search("title 299").first()["title"] == "title 299"


def test_an_index_is_built_once_and_reloaded(spark, tmp_path):
    from quernstone.services import Engine

    one, two = entries(spark, [("Alpha", ["c"], "p" * 40, "角色")]), entries(spark, [("Beta", ["c"], "p" * 40, "角色")])
    postings.build(one, str(tmp_path))
    stored = postings.StoredIndex(spark, str(tmp_path))
    engine = Engine(stored)
    assert "Alpha" in engine.ask("/角色 alpha")[1] and engine.ask("/角色 beta")[0] == "none"
    postings.build(two, str(tmp_path))
    assert "Alpha" in engine.ask("/角色 alpha")[1]
    engine.reload(stored.reload())
    assert engine.ask("/角色 alpha")[0] == "none" and "Beta" in engine.ask("/萌百搜索 beta")[1] and engine.ask("/随机角色")[0] == "random"
    postings.remove_old(spark, str(tmp_path), 1)
    assert "Beta" in engine.ask("/角色 beta")[1]
    with pytest.raises(FileNotFoundError):
        postings.StoredIndex(spark, f"{tmp_path}/nowhere")


# ── one rate ────────────────────────────────────────────────────────────────


def timed(url):
    """A client that notes when it is asked, and fails each address of a third once."""
    folder, name = url.rsplit("/", 1)
    again = os.path.exists(f"{folder}/{name}")
    with open(f"{folder}/{name}", "a") as f:
        f.write(f"{time.time()}\n")
    return (200, {}, "ok") if again or int(name) % 3 else (503, {}, "")


def test_all_streams_keep_one_rate(spark, tmp_path):
    urls = spark.createDataFrame([(f"{tmp_path}/{i}",) for i in range(12)], "url string")
    settings = C.Settings(rate_limit=0.15, jitter=0.1, first_wait=0.01, retry_jitter=0.01)
    got = live.fetch_urls(urls, "tests.test_stores:timed", settings).collect()
    assert Counter((r["outcome"], r["attempts"]) for r in got) == {("ok", 1): 8, ("ok", 2): 4}
    times = sorted(float(x) for p in tmp_path.iterdir() for x in p.read_text().split())
    assert len(times) == 16 and min(b - a for a, b in zip(times, times[1:], strict=False)) >= 0.14
    out = api.fetch(spark, [f"{tmp_path}/{i}" for i in range(20, 29)], "tests.test_stores:timed", gap=0.1, jitter=0.05, concurrent=3).collect()
    times = sorted(float(x) for p in tmp_path.iterdir() if int(p.name) >= 20 for x in p.read_text().split())
    assert len(out) == 9 and min(b - a for a, b in zip(times, times[1:], strict=False)) >= 0.09


def test_slots_of_a_late_stream(spark):
    now, slept = [100.0], []
    slots = api.Slots(100.0, 1, 3, 0.5, 0.0, clock=lambda: now[0], sleep=slept.append)
    assert slots.wait() == 0.5 and slots.wait() == 2.0
    now[0] = 110.1
    assert abs(slots.wait() - 0.9) < 1e-9  # slots of this stream begin at 100.5, 102, ... 111
    assert api.Slots(0.0, gap=0.0, jitter=0.0).wait() == 0.0


# ── waves ───────────────────────────────────────────────────────────────────


def slow_wiki(url):
    """A client of one category with 40 pages that notes each title it is asked for and takes its time."""
    parts = urlsplit(url)
    folder = parts.path.rsplit("/", 1)[0]
    asked = parse_qs(parts.query).get("titles")
    if not asked:
        items = "".join(f'<li><a href="/x" title="P {i:02d}">p</a></li>' for i in range(40))
        return 200, {}, f'<div id="mw-pages"><ul>{items}</ul></div>'
    found = {}
    for i, t in enumerate(asked[0].split("|")):
        with open(f"{folder}/log", "a") as f:
            f.write(t + "\n")
        bad = t == "P 07" and not os.path.exists(f"{folder}/mended")
        found[str(i)] = {"title": t, "missing": ""} if bad else {"title": t, "pageid": i, "lastrevid": 1, "touched": "2026-01-02T03:04:05Z", "extract": f"== {t} ==\nText."}
        time.sleep(0.05 if os.path.exists(f"{folder}/mended") else 0.15)
    return 200, {}, json.dumps({"query": {"pages": found}})


def test_a_signal_ends_the_wave_and_a_second_run_asks_for_the_rest(spark, tmp_path):
    settings = C.Settings(base_url=f"file://{tmp_path}", api_url=f"file://{tmp_path}/api", root_category="Category:R", rate_limit=0, jitter=0, fetch_batch=8, titles_per_request=2, output_dir=str(tmp_path / "out"), strict=False)
    cache, log = str(tmp_path / "cache"), tmp_path / "log"

    def interrupt():
        while len(os.listdir(tmp_path / "cache/waves") if (tmp_path / "cache/waves").exists() else []) < 2:
            time.sleep(0.05)
        time.sleep(0.4)  # in mid-wave
        os.kill(os.getpid(), signal.SIGINT)

    threading.Thread(target=interrupt, daemon=True).start()
    with live.Interrupt(spark) as stop:
        result = live.run_crawl(spark, "tests.test_stores:slow_wiki", settings, cache, stop)
    assert stop.asked
    done = {r["title"] for r in result.pages.where("status = 'completed'").collect()}
    assert 7 <= len(done) < 39 and result.pages.where("status = 'failed'").count() == 1
    asked = set(log.read_text().split("\n")[:-1])
    assert done <= asked and len(asked) < 40
    log.unlink()
    (tmp_path / "mended").touch()
    again = live.run_crawl(spark, "tests.test_stores:slow_wiki", settings, cache)
    assert {r["title"]: r["status"] for r in again.pages.collect()} == {f"P {i:02d}": "completed" for i in range(40)}
    second = log.read_text().split("\n")[:-1]
    assert set(second) == {f"P {i:02d}" for i in range(40)} - done and "P 07" in second[:8]  # the failed page is in the first wave


def test_errors_of_failed_pages(spark, sf_dir):
    rows = live.fetch_wave(spark.createDataFrame([(f"x p{i}",) for i in range(8)], "title string"), "quernstone.queries_io:_answer", C.Settings(rate_limit=0, jitter=0, titles_per_request=1, attempts=2, first_wait=0, retry_jitter=0))
    assert {r["title"]: (r["status"], r["error"], r["attempts"]) for r in rows.collect()} == {
        "x p0": ("completed", None, None), "x p1": ("failed", "missing", 1), "x p2": ("failed", "badtoken", 1), "x p3": ("failed", "server_error", 2),
        "x p4": ("failed", "rate_limit", 2), "x p5": ("failed", "auth_page", 1), "x p6": ("failed", "http_error", 1), "x p7": ("completed", None, None),
    }


# ── rows and files that must not be lost ────────────────────────────────────


def test_batches_keep_titles_without_an_id(spark):
    rows = spark.createDataFrame([("a", 3), ("b", None), ("c", 1), ("d", None), ("c", 1), ("e", 10**15)], "title string, page_id long")
    got = [(r["batch_no"], r["n_titles"], r["titles"]) for r in merge.batches(rows, 4).orderBy("batch_no").collect()]
    assert got == [(0, 4, "c|c|a|e"), (1, 2, "b|d")]
    assert merge.batches(rows.limit(0)).count() == 0


def test_empty_files_are_seen(spark, tmp_path):
    from quernstone.operators import quality

    for name, text in (("角色/x.md", "text"), ("角色/empty.md", ""), ("角色/deep/empty.md", ""), ("other/blank.md", " \n"), ("other/none.md", ""), ("top.md", ""), ("a.txt", "")):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    whole = {r["path"]: r["raw"] for r in files.read_markdown(spark, str(tmp_path), None).collect()}
    assert whole == {f"{tmp_path}/{n}": t for n, t in (("角色/x.md", "text"), ("角色/empty.md", ""), ("角色/deep/empty.md", ""), ("other/blank.md", " \n"), ("other/none.md", ""), ("top.md", ""))}
    assert {r["file_name"]: r["directory"] for r in files.read_markdown(spark, str(tmp_path)).collect()} == {"x.md": "角色", "empty.md": "角色"}
    assert {r["path"]: r["size"] for r in files.manifest(spark, str(tmp_path)).collect()} == {"角色/x.md": 4, "角色/empty.md": 0, "角色/deep/empty.md": 0, "other/blank.md": 2, "other/none.md": 0, "top.md": 0, "a.txt": 0}
    assert quality.file_metrics(files.read_markdown(spark, f"file://{tmp_path}", None)).count() == 6


def test_small_tables_are_dealt_out(spark, sf_dir):
    counts = [r["count"] for r in fx.wiki_pages(spark, sf_dir).groupBy(F.spark_partition_id()).count().collect()]
    assert len(counts) == spark.sparkContext.defaultParallelism and max(counts) <= 2 * sum(counts) / len(counts)


def listing_wiki(url):
    """Listings of three pages; each request is noted, and the second page fails while ``broken`` is there."""
    parts = urlsplit(url)
    folder, mark = parts.path.rsplit("/", 1)[0], int(parse_qs(parts.query).get("pagefrom", ["1"])[0].split()[-1])
    if mark == 2 and os.path.exists(f"{folder}/broken"):
        return 404, {}, ""
    with open(f"{folder}/log", "a") as f:
        f.write(f"{parts.path.rsplit('/', 1)[1]} {mark}\n")
    more = f'<a href="/x?pagefrom=m+{mark + 1}">下一页</a>' if mark < 3 else ""
    return 200, {}, f'<div id="mw-pages"><ul><li><a title="P{mark}">p</a></li></ul></div>{more}'


def test_a_listing_stream_goes_on_after_its_last_page(spark, tmp_path):
    from quernstone.sources import listing, listing_stream

    settings = C.Settings(base_url=str(tmp_path), rate_limit=0, jitter=0)

    def run():
        pages = listing_stream.stream_listings(spark, ["Category:A", "Category:B"], "tests.test_stores:listing_wiki", str(tmp_path / "state"), settings)
        out = listing.members(pages).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).start()
        try:
            out.processAllAvailable()
        finally:
            out.stop()

    (tmp_path / "broken").touch()
    with pytest.raises(Exception, match="404"):
        run()
    assert sorted((tmp_path / "log").read_text().split("\n")[:-1]) == ["Category:A 1", "Category:B 1"]
    (tmp_path / "broken").unlink()
    run()
    run()
    asked = (tmp_path / "log").read_text().split("\n")[:-1]
    assert sorted(asked) == [f"Category:{c} {i}" for c in "AB" for i in (1, 2, 3)]
    rows = sorted((r["parent"], r["title"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert rows == [(f"Category:{c}", f"P{i}") for c in "AB" for i in (1, 2, 3)]


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(f"d{i % 3}/f{i}.md", "x") for i in range(20)] + [("../bad.md", "x")], "path string, content string").repartition(4)
    with pytest.raises(Exception, match="outside"):
        files.write_files(rows, str(tmp_path / "root"))
    assert [p for p in (tmp_path / "root").rglob("*")] == []
    files.write_files(rows.where("path NOT LIKE '..%'"), str(tmp_path / "root"))
    assert len([p for p in (tmp_path / "root").rglob("*.md")]) == 20 and not list((tmp_path / "root").glob(".staging*"))


def test_documents_are_joined_in_order(spark, tmp_path):
    lines = spark.range(5000).select(F.col("id").alias("line_no"), F.concat(F.lit("line "), F.col("id").cast("string")).alias("line")).repartition(7)
    files.write_report(lines, f"{tmp_path}/report.txt")
    assert (tmp_path / "report.txt").read_text() == "".join(f"line {i}\n" for i in range(5000))
    files.write_json(lines.select("line_no", F.to_json(F.struct("line_no")).alias("j")), "j", f"{tmp_path}/a.json", F.col("line_no"))
    files.write_json(lines.select("line_no", F.to_json(F.struct("line_no")).alias("j")), "j", f"{tmp_path}/a.json", F.col("line_no"))
    assert [x["line_no"] for x in json.loads((tmp_path / "a.json").read_text())] == list(range(5000))
    files.write_json(lines.limit(0), "line", f"{tmp_path}/none.json", F.col("line_no"))
    assert json.loads((tmp_path / "none.json").read_text()) == []
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["a.json", "none.json", "report.txt"]


def _tree(root, paths):
    for p in paths:
        (root / p).parent.mkdir(parents=True, exist_ok=True)
        (root / p).write_text("x" * len(p))


def test_many_small_folders_make_few_tasks(spark, tmp_path):
    paths = {f"d{i}/a.py" for i in range(300)} | {"top.txt", "d1/e/f/deep.txt"}
    _tree(tmp_path, paths)
    found = files.list_files(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert {(r["path"], r["size"]) for r in found.collect()} == {(p, len(p)) for p in paths}


def test_files_of_one_folder_are_dealt_out(spark, tmp_path):
    _tree(tmp_path, [f"output/f{i}.txt" for i in range(200)])
    found = files.list_files(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(found) == spark.sparkContext.defaultParallelism and max(r["count"] for r in found) < 100


def test_reading_many_files_makes_few_tasks(spark, tmp_path):
    names = [f"f{i}.md" for i in range(198)] + [".dotted.md", "100%41 + b.md"]  # scans of Spark take a dotted name for hidden
    _tree(tmp_path, [f"角色/{n}" for n in names])
    for found in (files.read_markdown(spark, str(tmp_path), None), files.read_markdown(spark, str(tmp_path))):
        assert found.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
        assert sorted(map(tuple, found.collect())) == sorted((f"{tmp_path}/角色/{n}", "角色", n, "x" * (len(n) + 3)) for n in names)


def test_a_tree_is_deleted_by_tasks(spark, tmp_path):
    _tree(tmp_path, ["out/a/b/c.md", "out/a/d.txt", "out/e.md", "kept.md"])
    (tmp_path / "out/empty").mkdir()
    tracker, group = spark.sparkContext.statusTracker(), "deleting"
    spark.sparkContext.setJobGroup(group, group)
    files.clean_output(spark, f"{tmp_path}/out")
    files.clean_output(spark, f"{tmp_path}/out")
    jobs = tracker.getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("other", "other")
    assert jobs and [p.name for p in tmp_path.iterdir()] == ["kept.md"]


def test_a_json_document_is_read_back_in_parts(spark, tmp_path):
    rows = spark.range(3000).select("id", F.to_json(F.struct("id", F.repeat(F.lit("é,\n"), (F.col("id") % 40).cast("int")).alias("t"))).alias("j")).repartition(7)
    files.write_json(rows, "j", f"{tmp_path}/a.json", F.desc("id"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        back = files.read_json(spark, f"{tmp_path}/a.json", "id long, t string")
        assert spark.read.text(f"{tmp_path}/a.json").rdd.getNumPartitions() > 4
        got = sorted((r["place"], r["value"]["id"], r["value"]["t"]) for r in back.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(i, 2999 - i, "é,\n" * ((2999 - i) % 40)) for i in range(3000)]
    files.write_json(rows.limit(0), "j", f"{tmp_path}/none.json", F.col("id"))
    assert files.read_json(spark, f"{tmp_path}/none.json", "id long").count() == 0


def _runs(spark):
    """An accumulator and a column function that adds to it for each row."""
    runs = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        runs.add(1)
        return text

    return runs, counted


def test_a_document_makes_its_rows_once(spark, tmp_path):
    runs, counted = _runs(spark)
    files.write_json(spark.range(0, 100, 1, 5).select("id", F.to_json(F.struct(counted(F.col("id").cast("string")).alias("x"))).alias("j")), "j", f"{tmp_path}/a.json", F.col("id"))
    assert runs.value == 100


def test_images_are_resolved_with_entries_made_once(spark):
    runs, counted = _runs(spark)
    entries = spark.range(50).select(counted(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("title"), F.lit("角色").alias("category_dir"))
    found = index.resolve_images(entries, spark.createDataFrame([("images/character/t7.png",)], "path string"))
    assert {(r["title"], r["image"]) for r in found.where("image <> ''").collect()} == {("t7", "images/character/t7.png")} and found.count() == 50
    assert runs.value == 50


def test_run_document_parses_pages_once(spark, sf_dir):
    from quernstone.queries import queries

    plan = queries()["run_document"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("documents.parquet") == 1  # the counters, which parse nothing
