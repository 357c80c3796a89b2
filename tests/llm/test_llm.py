"""The corpus operators against brute force, round trips and held-out accuracy."""

import hashlib
import math
import pathlib
import random
import re
import textwrap
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quernstone.llm import chat, common, decontaminate, langid, license_texts, licenses, mixing, neardup, quality, queries, repeats, sharding, urls

DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD_TEXTS = [None, "", " \n\t ", "!!! ???", "one", "a b c d e f g h i j k l m n o p", "é " * 30, "word " * 5000, "word " * 5000]


def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and a column whose name clashes."""
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "null id here", None, None, None), (3, "!!! ???", "en", "s", 1), (3, "!!! ???", "en", "s", 1)]
    return spark.createDataFrame(rows, DOC).withColumn("shard", F.lit("x")).withColumn("spans", F.lit(1)).withColumn("key", F.lit(2))


def empty_docs(spark):
    return spark.createDataFrame([], DOC)


def prose(rng, n, vocabulary=2000):
    return " ".join(f"w{int(rng.random() ** 2 * vocabulary)}" for _ in range(n))


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_sql(spark, oracle, name):
    oracle(spark, name, queries.queries()[name], queries.oracle_sql()[name])


# ── 1 ───────────────────────────────────────────────────────────────────────


def brute_phrases(text, sample):
    norm = lambda t: "".join(c.lower() if c.isalpha() else " " for c in t)
    text, sample, n, i = norm(text), norm(sample), 0, 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i : i + k + 1] in sample:
            k += 1
        i, n = i + k, n + 1
    return n


def test_cross_parsing_against_brute_force():
    rng = random.Random(1)
    samples = langid.Samples(("a", "b"), tuple("".join(rng.choice(x) for _ in range(800)) for x in ("abc de", "bcéfg ")))
    p = langid.parser(samples)
    texts = ["".join(rng.choice("abcdefgé ZÉ!9") for _ in range(n)) for n in (1, 7, 255, 256, 257, 900)] + [""]
    # phrases over several blocks, and a text that only meets the block-wise parse far behind
    texts += [samples.texts[0], samples.texts[0][100:700] * 2, "x" * 200 + samples.texts[1][3:] + samples.texts[0][5:], "ab" * 700]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    got = p.phrases(points, np.cumsum([0, *map(len, texts)]))
    assert got.tolist() == [[brute_phrases(t, s) for s in samples.texts] for t in texts]


PERIODIC = ["a", "0 1 2 ", " ", "ab", "abc de", "\u00e9", "a" * 7 + "b" * 5]


@pytest.mark.parametrize("unit", PERIODIC)
def test_cross_parsing_of_periodic_text(unit):
    """The phrases are those of brute force, and 10 MB take seconds."""
    rng = random.Random(2)
    texts = tuple("".join(rng.choice(x) for _ in range(900)) for x in ("abc de", "bc\u00e9fg a"))
    p = langid.Parser(langid.Samples(("a", "b"), texts))
    for n in (langid.BLOCK - 1, 3000, 5001):
        text = (unit * n)[:n] + rng.choice(["", "b", "xyz"])
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        assert p.phrases(points, np.array([0, len(points)]))[0].tolist() == [brute_phrases(text, t) for t in texts]
    points = np.frombuffer((unit * 10_000_000)[:10_000_000].encode("utf-32-le"), np.uint32)
    began = time.perf_counter()
    p.phrases(points, np.array([0, len(points)]))
    assert time.perf_counter() - began < 20


def test_table_at_the_bound_of_the_sample_is_small():
    rng = random.Random(8)
    samples = langid.Samples(tuple("abcdefghij"), tuple("".join(chr(97 + rng.randrange(120)) for _ in range(24_000)) for _ in range(10)))
    assert langid.Parser(samples).table.nbytes < 200 << 20


def test_cross_parsing_of_large_alphabets():
    rng = random.Random(2)
    alphabets = [[chr(0xAC00 + i) for i in range(1500)], [chr(0x4E00 + i) for i in range(2000)], [chr(0x4E00 + i) for i in range(1000, 3000)], list("abcdefg ")]
    samples = langid.Samples(("ko", "zh", "ja", "en"), tuple("".join(rng.choice(x) for _ in range(3000)) for x in alphabets))
    p = langid.parser(samples)
    texts = [s[i : i + n] for s in samples.texts for i, n in ((0, 40), (700, 300), (2990, 10), (100, 2000))]
    texts += ["".join(rng.choice(rng.choice(alphabets) + list(" é가힣龜")) for _ in range(n)) for n in (1, 2, 255, 256, 257, 900)] + [""]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    got = p.phrases(points, np.cumsum([0, *map(len, texts)]))
    assert got.tolist() == [[brute_phrases(t, s) for s in samples.texts] for t in texts]


def test_rare_letters_tell_a_language():
    rng = random.Random(3)
    samples = langid.Samples(("ja", "ko", "zh"), tuple("".join(chr(a + min(rng.randrange(2000), rng.randrange(2000))) for _ in range(6000)) for a in (0x4E00, 0xAC00, 0x6E00)))
    texts = [x[i : i + 5] for x in samples.texts for i in range(0, 6000, 300)]
    assert langid.predict(pa.array(texts), samples)[0] == [l for l in samples.langs for _ in range(20)]


def test_language_id_on_held_out_rows(spark, sf_dir):
    rows = queries.op1_language_id(spark, sf_dir).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_rare_texts_are_learned_from(spark):
    rows = spark.range(200_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 20_000 == 0, "some words").otherwise(F.when(F.col("id") % 2 == 0, "!? 12")).alias("text"), F.lit("xx").alias("lang"))
    assert langid.collect_samples(rows) == langid.collect_samples(rows.where("text = 'some words'"))
    assert langid.collect_samples(rows).langs == ("xx",)


def test_language_id_odd_rows(spark):
    docs = odd_docs(spark)
    samples = langid.collect_samples(docs)
    rows = langid.identify(docs, samples).collect()
    assert len(rows) == docs.count()
    assert all((r["lang_pred"] == "und") == (not any(map(str.isalpha, t or ""))) for r, t in zip(rows[: len(ODD_TEXTS)], ODD_TEXTS, strict=True))
    assert langid.identify(empty_docs(spark), langid.collect_samples(empty_docs(spark))).count() == 0
    assert [r["lang_pred"] for r in langid.identify(docs.where("doc_id = 4"), langid.Samples((), ())).collect()] == ["und"]
    broken = spark.range(1).select(F.col("id").alias("doc_id"), F.expr("CAST(X'80616280FF' AS STRING)").alias("text"))
    assert langid.identify(broken, samples).count() == 1
    kept = langid.keep_identified(docs, samples)
    assert kept.columns == docs.columns and kept.where("lang IS NULL").count() == 0


# ── 2 ───────────────────────────────────────────────────────────────────────


def word_list(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_decontamination_against_brute_force(spark):
    rng = random.Random(2)
    items = [(i, prose(rng, n, 60)) for i, n in enumerate((20, 13, 5, 1, 40))] + [(9, None), (10, "?!"), (2, "W1 w2")]
    docs = [(i, prose(rng, 60, 60) + " " + rng.choice(items[:5])[1].upper().replace(" ", ",\n") + " " + prose(rng, rng.randrange(400), 60)) for i in range(40)]
    docs += [(100, None), (101, ""), (102, "w1, W2")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expected = {}
    for doc_id, text in docs:
        words, hit, ids = word_list(text), set(), set()
        for item_id, t in items:
            w = word_list(t)
            n = min(13, len(w))
            grams = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
            at = [k for k in range(len(words) - n + 1) if tuple(words[k : k + n]) in grams] if grams else []
            hit.update(x for k in at for x in range(k, k + n))
            ids.update([str(item_id)] if at else [])
        expected[doc_id] = (len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words))
    for most in (1 << 20, 100):  # one automaton, and several
        rows = decontaminate.digests(decontaminate.scan(d, i, item_bytes=most)).collect()
        assert {r["doc_id"]: tuple(r)[1:] for r in rows} == expected
        kept = {r["doc_id"] for r in decontaminate.remove_contaminated(d, i, item_bytes=most).collect()}
        assert kept == {k for k, v in expected.items() if not v[4]}
    for r in decontaminate.scan(d, i).collect():
        text = dict(docs)[r["doc_id"]]
        for a, b in zip(r["word_spans"], r["byte_spans"], strict=True):
            assert word_list(text.encode()[b["start"] : b["end"]].decode()) == word_list(text)[a["start"] : a["end"]]


def test_decontamination_by_items_without_id(spark, tmp_path):
    """Code and SQL agree that items with a null id are hit, and that they count as one item together."""
    items = spark.createDataFrame([(None, "one two three"), (None, "four five"), (7, "four five"), (8, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x one two three y"), (2, "four five one two three"), (3, "nothing here"), (4, None)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    expected = sorted(con.execute(queries.oracle_sql()["op2_decontamination"]).fetchall())
    assert sorted(map(tuple, queries.op2_decontamination(spark, str(tmp_path)).collect())) == expected
    assert [r[2:4] for r in expected] == [(3, 1), (5, 2), (0, 0), (0, 0)]
    for most in (1 << 20, 10):  # one automaton, and several
        assert sorted(map(tuple, decontaminate.digests(decontaminate.scan(docs, items, item_bytes=most)).collect())) == expected
        assert {r["doc_id"] for r in decontaminate.remove_contaminated(docs, items, item_bytes=most).collect()} == {3, 4}


def test_decontamination_odd_rows(spark):
    items = spark.createDataFrame([(None, "x"), (1, None)], "item_id long, text string")
    assert decontaminate.scan(odd_docs(spark), items).count() == odd_docs(spark).count()
    assert decontaminate.scan(empty_docs(spark), items).count() == 0
    assert decontaminate.remove_contaminated(odd_docs(spark), items.limit(0)).count() == odd_docs(spark).count()


# ── 3 ───────────────────────────────────────────────────────────────────────

EVENTS = "conv_id long, seq long, message_id string, kind string, role string, text string"


def test_chat_folds_events_and_round_trips(spark):
    nasty = r"\### </turn> <turn>assistant &amp; &lt; &nl; ok"
    log = [
        (1, 0, "m1", "message", "user", nasty),
        (1, 5, "m2", "delta", "assistant", "par"), (1, 3, "m2", "delta", "assistant", "first "), (1, 6, "m2", "regenerate", "assistant", None), (1, 7, "m2", "delta", "assistant", "new "), (1, 8, "m2", "delta", "assistant", "answer<"),
        (1, 9, "m1", "edit", "user", nasty + "!"),
        (1, 20, None, "message", "assistant", "same"), (1, 20, None, "message", "assistant", "same"), (1, 300, None, "message", "role\nwith\nlines", None),
        (1, 7, "m2", "delta", "assistant", "new "), (None, None, None, "message", None, None), (None, 1, "m1", None, "", ""),
    ]
    events = spark.createDataFrame(log, EVENTS).withColumn("formatted", F.lit(1)).withColumn("piece", F.lit("x"))
    rows = {r["conv_id"]: r for r in chat.format_conversations(events).select("conv_id", "loss", "formatted", chat.parse(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("said")).collect()}
    assert [tuple(t) for t in rows[1]["turns"]] == [("user", nasty + "!"), ("assistant", "new answer<"), ("assistant", "same"), ("assistant", "same"), ("role\nwith\nlines", "")]
    assert rows[1]["said"] == "new answer<samesame" and [s["turn"] for s in rows[1]["loss"]] == [1, 2, 3]
    assert [tuple(t) for t in rows[None]["turns"]] == [("", ""), ("", "")] and not rows[None]["loss"]
    assert chat.format_conversations(spark.createDataFrame([], EVENTS)).count() == 0


def test_long_conversation_stays_in_order(spark):
    log = [(1, i, None, "message", "user", str(i)) for i in range(1000)]
    row = chat.format_conversations(spark.createDataFrame(log, EVENTS).repartition(8)).select(chat.parse(F.col("formatted")).alias("t")).first()
    assert [t["text"] for t in row["t"]] == [str(i) for i in range(1000)]


def test_chat_rows_go_through_the_fold(spark):
    rng = random.Random(31)
    long = "".join(rng.choice("ab<&\n\r é€😀 ") for _ in range(300_000))
    rows = [(1, 0, "user", None), (1, 1, "assistant", long), (1, 1, "assistant", "x" * 256), (1, 1, "assistant", "x" * 256), (1, 2, None, ""), (1, None, "", "😀" * 257), (None, -3, "assistant", "</turn>\n"), (None, 1 << 62, "assistant", "a"), (None, (1 << 62) - 1, "", "b")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit(1)).withColumn("part", F.lit("x"))
    log = chat.events_of(table)
    assert {r["kind"] for r in log.collect()} == {"message", "delta"}
    found = chat.digests(chat.format_conversations(log, F.floor(F.col("seq.turn") / chat.PIECE))).collect()
    for r in found:
        turns = sorted(((t is not None, t or 0), role or "", x or "") for c, t, role, x in rows if c == r["conv_id"])
        loss = "".join(x for _, role, x in turns if role == "assistant")
        said = "".join(f"{role}\n{x}\n" for _, role, x in turns)
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest() and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert len(found) == 2 and chat.events_of(table.limit(0)).count() == 0


# ── 4 ───────────────────────────────────────────────────────────────────────


def brute_capacity(sizes, shards):
    best = [0] + [math.inf] * len(sizes)
    for _ in range(shards):
        nxt = list(best)
        for j in range(1, len(sizes) + 1):
            total = 0
            for i in range(j - 1, -1, -1):
                total += sizes[i]
                nxt[j] = min(nxt[j], max(best[i], total))
        best = nxt
    return best[-1]


def test_capacity_is_least():
    rng = random.Random(4)
    for _ in range(200):
        sizes = [rng.randrange(1, 100) for _ in range(rng.randrange(1, 40))]
        for shards in (1, 3, 16):
            c = sharding.capacity_of(sizes, shards)
            assert c == brute_capacity(sizes, shards)
            cuts = [0, *sharding.even_cuts(sizes, c, shards), len(sizes)]
            parts = [sum(sizes[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
            assert max(parts) <= c and sum(parts) == sum(sizes) and len(parts) == min(shards, len(sizes)) and min(parts) > 0


def shards_of(plan, keys):
    return [plan.heavy.index(k) if k in plan.heavy else len(plan.heavy) + sum(k + (1 << 63) >= x for x in plan.cuts) for k in keys]


@pytest.mark.parametrize("cells", [64, sharding.CELLS])
@pytest.mark.parametrize("part", [0, 5, 10, 30, 60])
def test_cuts_from_histograms(spark, cells, part):
    rng = random.Random(5 + part)
    n = 40_000 if cells == sharding.CELLS else 3000
    keys = sorted(rng.randrange(-(1 << 63), 1 << 63) for _ in range(n)) + [(1 << 63) - 1]
    sizes = [rng.randrange(1, 1000) for _ in keys]
    sizes[n // 3] = max(1, sum(sizes) * part // (100 - part))
    sizes[n // 3 + 1] = sizes[n // 3] // 3 + 1
    plan = sharding.plan_shards(spark.createDataFrame(list(zip(keys, sizes, strict=True)), "key long, bytes long"), 16, cells)
    top = sorted(((z, k) for z, k in zip(sizes, keys, strict=True)), reverse=True)[: len(plan.heavy)]
    assert plan.heavy == [k for _, k in top]
    rest = [z for z, k in zip(sizes, keys, strict=True) if k not in plan.heavy]
    left = 16 - len(top)
    assert (part < 10 or top) and max(rest) * left < sum(rest)
    least = sharding.capacity_of(rest, left)  # itself held against brute force
    assert plan.capacity == max([least, *(z for z, _ in top)])
    total = Counter()
    for z, s in zip(sizes, shards_of(plan, keys), strict=True):
        total[s] += z
    assert set(total) == set(range(16)) and max(total[s] for s in range(len(top), 16)) <= least
    assert [total[i] for i in range(len(top))] == [z for z, _ in top]
    if not part:
        assert max(total.values()) < 1.03 * min(total.values())


def test_few_groups_leave_no_shard_empty(spark):
    for sizes in ([7] * 20, [1000] + [1] * 16, [60] * 15 + [1] * 5, [5], [3, 3]):
        keys = [k * 10**17 for k in range(len(sizes))]
        plan = sharding.plan_shards(spark.createDataFrame(list(zip(keys, sizes, strict=True)), "key long, bytes long"))
        assert len(set(shards_of(plan, keys))) == min(16, len(sizes))


@pytest.mark.parametrize("ids", ["string", "null", "outlier", "same"])
def test_slots_of_any_ids(spark, monkeypatch, ids):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 50)
    rows = [(1 << 60 if i == 0 else i, "common" if i % 3 == 0 else f"text {i % 700}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    if ids == "string":
        docs = docs.withColumn("doc_id", F.concat(F.lit("x"), F.col("doc_id")))
    if ids == "null":
        docs = docs.withColumn("doc_id", F.lit(None).cast("long"))
    if ids == "same":
        docs = docs.withColumn("doc_id", F.lit(1)).withColumn("text", F.lit("t"))
    by = defaultdict(list)
    for r in sharding.shard_documents(docs).collect():
        by[r["shard"]].append(r["slot"])
    assert sum(map(len, by.values())) == 2000 and all(sorted(s) == list(range(len(s))) for s in by.values())


def test_sharding_query(spark, sf_dir):
    rows = queries.op4_sharding(spark, sf_dir).collect()
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    by, same = defaultdict(list), defaultdict(set)
    for r in rows:
        by[r["shard"]].append(r["slot"])
        same[text[r["doc_id"]]].add(r["shard"])
        assert (r["size"], r["text_crc32"]) == (len(text[r["doc_id"]].encode()) + 1, zlib.crc32(text[r["doc_id"]].encode()))
    assert len(rows) == len(text) and set(by) <= set(range(16)) and all(len(s) == 1 for s in same.values())
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    loads, groups = Counter(), Counter()
    for r in rows:
        loads[r["shard"]] += r["size"]
        groups[text[r["doc_id"]]] += r["size"]
    assert len(loads) == 16 and max(loads.values()) <= sum(loads.values()) / 16 + max(groups.values())  # no capacity needs more


def test_sharding_odd_rows(spark):
    docs = odd_docs(spark)
    rows = sharding.shard_documents(docs).collect()
    assert len(rows) == docs.count() and len({(r["shard"], r["slot"]) for r in rows}) == len(rows)
    assert sharding.shard_documents(empty_docs(spark)).count() == 0


# ── 5 ───────────────────────────────────────────────────────────────────────


def brute_targets(sizes):
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    target, full, left = {}, set(), 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in sizes if s not in full]
        w = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / w > 2 * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / w for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
        full, left = full | set(over), left - sum(2 * sizes[s] for s in over)


def mix_docs(spark, n=3000, sources=7):
    rng = random.Random(6)
    rows = [(i, "w " * int(rng.paretovariate(2.5) * 20), "en", f"s{min(int(rng.random() ** 2 * sources), sources - 1)}" if i % 50 else None, 1) for i in range(n)]
    return spark.createDataFrame(rows, DOC)


def test_mix_targets_and_totals(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 64)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    docs = mix_docs(spark)
    rows = mixing.mix(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
    expected, taken, least = brute_targets(sizes), Counter(), defaultdict(lambda: math.inf)
    for r in rows:
        taken[r["source"]] += r["copies"] * r["size"]
        least[r["source"]] = min(least[r["source"]], r["size"])
        assert r["copies"] in (0, 1, 2) and r["target"] == pytest.approx(expected[r["source"]])
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= max(2 * least[s], 0.01 * expected[s])
    again = mixing.mix(docs.repartition(13)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    copies = Counter({r["id"]: r["copies"] for r in rows if r["copies"]})
    assert Counter(r["doc_id"] for r in mixing.repeat_rows(docs).collect()) == copies


@pytest.mark.parametrize("n", [0, 1, 2, 7, 300])
def test_targets_of_many_sources_by_ranges(spark, n):
    rng = random.Random(n)
    rows = [(None if i == 5 else f"s{i}", rng.randrange(1, 1000) ** 2) for i in range(n)]
    docs = spark.createDataFrame(rows * 2, "source string, size long")
    one, ranges = ({r["source"]: tuple(r)[1:] for r in mixing.source_targets(docs, k).collect()} for k in (1000, 0))
    expected = brute_targets({a: 2 * b for a, b in rows}) if rows else {}
    for got in (one, ranges):
        assert {a: x[:2] for a, x in got.items()} == {a: (2 * b, 2) for a, b in rows} and {a: x[2] for a, x in got.items()} == pytest.approx(expected)


def test_null_ids_and_repeated_rows_fill_no_bucket(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 100)
    rows = [(None, "w " * (1 + i % 7)) for i in range(30_000)] + [(4, "the same row")] * 10_000
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
    seen = []
    level = mixing._level
    monkeypatch.setattr(mixing, "_level", lambda r, k: seen.append(r.groupBy("source", "bucket").count().agg(F.max("count")).first()[0]) or level(r, k))
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows) and seen[0] < 1.3 * mixing.BUCKET_ROWS
    assert Counter(r["id"] for r in found) == Counter(i for i, _ in rows)
    assert abs(sum(r["size"] * r["copies"] for r in found) - found[0]["target"]) < 20 and {r["copies"] for r in found} == {1, 2}
    taken = Counter(r["doc_id"] for r in mixing.repeat_rows(docs).collect())
    assert taken == Counter({k: sum(r["copies"] for r in found if r["id"] == k) for k in (None, 4)})


def test_pivotal_rounding_is_fair_and_keeps_sums():
    rng = np.random.default_rng(7)
    size = np.sort(rng.integers(1, 100, 40))[::-1].astype(float)
    total, mean = [], np.zeros(40)
    for _ in range(4000):
        p = mixing.pivot_pool(size, 0.3, rng.random(40))
        assert ((p > 0) & (p < 1)).sum() <= 1
        total.append(p @ size)
        mean += p / 4000
        q = mixing.pivot(size, rng.random(40), rng.random(40))
        assert ((q > 0) & (q < 1)).sum() <= 1
    assert np.allclose(total, 0.3 * size.sum()) and np.abs(mean - 0.3).max() < 0.05


def test_repeated_rows_of_a_mix_do_not_depend_on_the_join(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i if i % 7 else None, prose(rng, rng.randrange(1, 60)), "en", rng.choice("abc"), 1) for i in range(200)]
    docs = spark.createDataFrame(rows + rows[:50], DOC)
    plain = Counter(mixing.repeat_rows(docs).collect())
    monkeypatch.setattr(common, "HASH_ROWS", 0)
    assert Counter(mixing.repeat_rows(docs).collect()) == plain


def test_only_a_bounded_side_is_held_in_memory(spark, monkeypatch):
    left, right = spark.range(10).withColumnRenamed("id", "a"), spark.range(10).withColumnRenamed("id", "b")
    plan = lambda: left.hint("merge").join(common.hashed(right, 10), F.col("a") == F.col("b"))._jdf.queryExecution().sparkPlan().toString()
    monkeypatch.setattr(common, "HASH_ROWS", 10)
    assert "shuffle_hash" in common.hashed(right, 40)._jdf.queryExecution().logical().toString()
    monkeypatch.setattr(common, "HASH_ROWS", 2)
    assert "shuffle_hash" not in common.hashed(right, 10)._jdf.queryExecution().logical().toString()
    assert "SortMergeJoin" in plan()


def test_mix_odd_rows(spark):
    docs = odd_docs(spark)
    assert mixing.mix(docs).count() == docs.count()
    assert mixing.mix(empty_docs(spark)).count() == 0
    assert mixing.repeat_rows(docs).columns == docs.columns
    assert mixing.mix(docs.where("text IS NULL")).first()["copies"] == 0


# ── 6 ───────────────────────────────────────────────────────────────────────


@pytest.mark.parametrize("most", [0, urls.BROADCAST_BYTES])
def test_urls_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(urls, "BROADCAST_BYTES", most)
    rng = random.Random(8)
    part = lambda: rng.choice("abc")
    rules = [(".".join(part() for _ in range(rng.randrange(1, 4))), "/" + "/".join(part() for _ in range(rng.randrange(3))), rng.choice(["block", "allow"])) for _ in range(300)]
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    pages = [(i, f"http://{'.'.join(part() for _ in range(4))}/{part()}/{part()}?q#f") for i in range(300)] + [(300, None), (301, "no scheme"), (302, "x://"), (303, "HTTP://A.B.C"), (303, "HTTP://A.B.C"), (None, "q://c/a")]
    got = urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string").withColumn("path", F.lit("clash")), spark.createDataFrame(rules, "host string, path string, verdict string")).collect()

    def brute(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fit = [(len(h + p), len(h), h, p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=None)
        return (host, path, best[2] + best[3], best[4]) if best else (host, path, None, "allow")

    assert sorted(map(str, [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got])) == sorted(map(str, [(i, *brute(u)) for i, u in pages]))
    assert urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame([], "host string, path string, verdict string")).where("verdict = 'allow'").count() == len(pages)


def test_long_and_common_urls(spark):
    rules = spark.createDataFrame([("a.b", "/x", "block")], "host string, path string, verdict string")
    long = "http://c.a.b/x" + "y/é" * 200_000
    pages = [(i, long if i % 3 else None) for i in range(90)] + [(100, "http://" + "a." * 300 + "b/xx"), (101, "")]
    table = spark.createDataFrame(pages, "page_id long, url string").withColumns({c: F.lit("clash") for c in ("host", "rule", "verdict", "key", "block", "h")})
    got = urls.judge_urls(table, rules)
    assert set(got.columns) == {"page_id", "url", "host", "path", "rule", "verdict", "key", "block", "h"}
    rows = {r["page_id"]: (r["host"], r["rule"], r["verdict"], len(r["path"])) for r in got.collect()}
    assert all(rows[i] == (("c.a.b", "a.b/x", "block", len(long) - 12) if i % 3 else ("", None, "allow", 0)) for i in range(90))
    assert rows[100][1:3] == ("a.b/x", "block") and rows[101] == ("", None, "allow", 0) and len(rows) == 92


# ── 7 ───────────────────────────────────────────────────────────────────────


def brute_repeats(docs, n):
    where = defaultdict(set)
    for i, t in docs:
        w = word_list(t)
        for k in range(len(w) - n + 1):
            where[tuple(w[k : k + n])].add(i)
    out = set()
    for i, t in docs:
        w = word_list(t)
        hit = sorted({x for k in range(len(w) - n + 1) if len(where[tuple(w[k : k + n])]) > 1 for x in range(k, k + n)})
        starts = [k for k in range(len(w) - n + 1) if len(where[tuple(w[k : k + n])]) > 1]
        spans = []
        for k in starts:
            if spans and k <= spans[-1][1]:
                spans[-1][1] = k + n
            else:
                spans.append([k, k + n])
        assert set(hit) == {x for a, b in spans for x in range(a, b)}
        out.update((i, a, b) for a, b in spans)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_against_brute_force(spark, seed):
    rng = random.Random(seed)
    parts = [prose(rng, rng.randrange(5, 40), 300) for _ in range(12)]
    docs = [(i, " ".join(rng.choice(parts) if rng.random() < 0.4 else prose(rng, rng.randrange(1, 25), 300) for _ in range(rng.randrange(1, 12)))) for i in range(80)]
    docs += [(200 + i, docs[0][1]) for i in range(15)] + [(300, None), (301, ""), (302, "É, " * 40), (303, "é " * 30)]
    rows = repeats.find_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(6), min_words=12, k=4).collect()
    assert {(r["doc_id"], r["start_word"], r["end_word"]) for r in rows} == brute_repeats(docs, 12) and len(rows) == len(brute_repeats(docs, 12))
    text = dict(docs)
    for r in rows:
        assert word_list(text[r["doc_id"]][r["start_char"] : r["end_char"]]) == word_list(text[r["doc_id"]])[r["start_word"] : r["end_word"]]


def brute_removal(docs, n):
    """Words that stay of each document if every window that a lesser id has goes."""
    least, out = {}, []
    rank = lambda i: (i is not None, i or 0)
    for i, t in docs:
        w = word_list(t)
        for k in range(len(w) - n + 1):
            g = tuple(w[k : k + n])
            least[g] = min(least.get(g, rank(i)), rank(i))
    for i, t in docs:
        w = word_list(t)
        gone = {x for k in range(len(w) - n + 1) if least[tuple(w[k : k + n])] < rank(i) for x in range(k, k + n)}
        out.append((i, [x for k, x in enumerate(w) if k not in gone]))
    return out


@pytest.mark.parametrize("ids", ["distinct", "repeated", "null", "string"])
def test_repeats_by_row_and_their_removal(spark, ids):
    """Rows that share an id are one document as to repeats, and yet each has its own spans."""
    rng = random.Random(71)
    parts = [prose(rng, rng.randrange(5, 40), 300) for _ in range(12)]
    of = {"distinct": lambda i: i, "repeated": lambda i: i % 13, "null": lambda i: i if i % 4 else None, "string": lambda i: f"d{i:03}" if i % 9 else None}[ids]
    docs = [(of(i), " ".join(rng.choice(parts) if rng.random() < 0.4 else prose(rng, rng.randrange(1, 25), 300) for _ in range(rng.randrange(1, 12)))) for i in range(80)]
    docs += docs[:3] + [(of(90), docs[5][1]), (of(91), None), (of(92), "É, x " * 40)]
    table = spark.createDataFrame(docs, f"doc_id {'string' if ids == 'string' else 'long'}, text string").withColumn("first_doc_id", F.lit(1)).withColumn("key", F.lit("x"))
    found = repeats.find_repeats(table, min_words=12, k=4).collect()
    rows = Counter((r["doc_id"], r["start_word"], r["end_word"]) for r in found)
    assert set(rows) == brute_repeats(docs, 12)
    left = [(r["doc_id"], word_list(r["text"])) for r in repeats.remove_repeats(table, min_words=12, k=4).collect()]
    assert sorted(map(str, left)) == sorted(map(str, brute_removal(docs, 12)))
    assert repeats.remove_repeats(table, min_words=12, k=4).columns == table.columns


def test_spans_of_rows_with_null_ids_stay_apart(spark):
    rng = random.Random(72)
    a, b = prose(rng, 60, 10**6), prose(rng, 60, 10**6)
    docs = [(None, a + " " + prose(rng, 70, 10**6)), (None, prose(rng, 55, 10**6) + " " + b), (1, a), (2, b)]
    rows = repeats.find_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["start_word"], r["end_word"]) for r in rows} == {(None, 0, 60), (None, 55, 115), (1, 0, 60), (2, 0, 60)}


def test_many_copies_of_a_row_take_linear_time(spark):
    rng = random.Random(6)
    passage, own = prose(rng, 80), [prose(rng, 300) for _ in range(2)]
    rows = [(1, f"{own[0]} {passage}")] * 10_000 + [(2, f"{own[1]} {passage}")]
    began = time.perf_counter()
    found = repeats.find_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_words"]) for r in found) == [(1, 80), (2, 80)] and time.perf_counter() - began < 60


def test_repeats_odd_rows(spark):
    rows = repeats.find_repeats(odd_docs(spark)).collect()
    assert {r["doc_id"] for r in rows} == {7, 8}
    assert repeats.find_repeats(empty_docs(spark)).count() == 0
    assert repeats.remove_repeats(odd_docs(spark)).count() == odd_docs(spark).count() and repeats.remove_repeats(empty_docs(spark)).count() == 0


# ── 8 ───────────────────────────────────────────────────────────────────────


def multiset(text):
    w = word_list(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute_classes(docs, threshold=0.8):
    sets, parent = [(i, multiset(t)) for i, t in docs], {i: i for i, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and sum((a & b).values()) >= threshold * sum((a | b).values()):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i, _ in docs}


def near_docs():
    rng = random.Random(9)
    docs = []
    for base in range(12):
        words = prose(rng, rng.randrange(20, 300)).split()
        for _ in range(rng.randrange(1, 14)):
            copy = list(words)
            for _ in range(rng.randrange(0, max(1, len(words) // 25))):
                copy[rng.randrange(len(copy))] = f"x{rng.random()}"
            docs.append((len(docs), " ".join(copy)))
    line = prose(rng, 60)
    docs += [(1000 + i, f"{prose(rng, 40)} {line} {prose(rng, 40)}") for i in range(40)]  # a common passage links nothing
    docs += [(2000, "a b a b a b a b a b a b"), (2001, "a b a b a b a b a b a b a b"), (2002, "one two"), (2003, "One, TWO"), (2004, ""), (2005, "")]
    return docs


@pytest.mark.parametrize("rows", [0, common.HASH_ROWS])
def test_near_duplicates_against_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(common, "HASH_ROWS", rows)
    docs = near_docs()
    rows = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == brute_classes(docs)


def test_signatures_are_unbiased():
    rng = np.random.default_rng(10)
    h = np.sort(rng.integers(0, 1 << 63, 60).astype(np.uint64))
    a, b = rng.integers(0, 6, 60), rng.integers(0, 6, 60)
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    found = []
    for k in range(60):
        own = np.sort(neardup.mix(h + np.uint64(k)))
        texts = np.concatenate([np.zeros(a.sum(), int), np.ones(b.sum(), int)])
        s = neardup.signatures(texts, np.concatenate([np.repeat(own, a), np.repeat(own, b)]), 2)
        found.append((s[0] == s[1]).mean())
    assert abs(np.mean(found) - truth) < 4 * math.sqrt(truth * (1 - truth) / (60 * neardup.COMPONENTS))


def test_bands_miss_almost_no_pair_at_the_threshold():
    rng = np.random.default_rng(11)
    agree = rng.random((20_000, neardup.COMPONENTS)) < neardup.SIMILARITY
    assert (~agree[:, neardup._CHOSEN].all(2).any(1)).sum() <= 2
    assert (agree.sum(1) + (~agree).sum(1) / 2 < neardup.SKETCH_LEAST).sum() == 0


def test_near_duplicates_odd_rows(spark):
    docs = odd_docs(spark)
    rows = neardup.near_duplicates(docs).collect()
    assert len(rows) == docs.count() and {r["doc_id"]: r["class_id"] for r in rows}[8] == 7
    assert neardup.near_duplicates(empty_docs(spark)).count() == 0
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [0, 1, 2, 3, 4, 5, 6, 7, None]))


# ── 9 ───────────────────────────────────────────────────────────────────────


def test_licenses(spark):
    varied = "Copyright (c) 2020 Some One\n\n" + license_texts.MIT.upper().replace("\n", " \r\n * ").replace("LICENSE", "LICENCE").replace('"', "'")
    texts = [varied, license_texts.BSD_3, license_texts.BSD_3 + " and more", "Copyright 2020 A\nAll rights reserved.", "", None, "released under the mit licence"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["license_id"] for r in licenses.scan_licenses(rows.unionByName(rows), licenses.known_digests(spark, license_texts.LICENSES)).collect()}
    assert got == {0: "MIT", 1: "BSD-3-Clause", 2: None, 3: None, 4: None, 5: None, 6: "MIT-notice"}
    assert licenses.scan_licenses(empty_docs(spark), licenses.known_digests(spark, license_texts.LICENSES)).count() == 0
    assert licenses.scan_licenses(odd_docs(spark), licenses.known_digests(spark, license_texts.LICENSES)).count() == odd_docs(spark).count()


def license_ids(spark, texts):
    known = licenses.known_digests(spark, license_texts.LICENSES)
    found = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), known)
    return [r["license_id"] for r in found.orderBy("doc_id").collect()]


def layouts(text):
    """The text re-wrapped at several widths, on one line, and as comments."""
    words = text.split()
    for width in (20, 33, *range(40, 121, 5), 1 << 20):
        lines = textwrap.wrap(" ".join(words), width, break_long_words=False)
        yield "\n".join(lines)
        yield "\r\n".join(" * " + x for x in lines)
    yield "\n".join(words)


def test_licenses_in_any_layout(spark):
    short = [(i, t) for i, t in license_texts.LICENSES]
    got = license_ids(spark, [x for _, t in short for x in layouts(t)])
    assert got == [i for i, t in short for _ in layouts(t)]
    for notice in ("Copyright (c) 2020 X", "Copyright 2019-2021, Some One <a@b.c>. All rights reserved.", "(c) 2020 X\nCopyright (c) 2021 Y\nAll rights reserved."):
        noticed = [(i, notice + "\n\n" + t) for i, t in short]
        got = license_ids(spark, [x for _, t in noticed for x in (t, *layouts(t))])
        assert got == [i for i, t in noticed for _ in (t, *layouts(t))]


def test_licenses_in_typographic_punctuation(spark):
    def curly(text, quotes, dash, space, bullet):
        text = re.sub(r'"([^"]*)"', quotes[0] + r"\1" + quotes[1], text).replace("'", "\u2019").replace("-", dash).replace("...", "\u2026")
        return f"\ufeff{bullet}{space}\xa9 2020 X\u2028" + "\n".join(bullet + space + x.replace("  ", space * 2).replace("software", "soft\xadware") for x in text.split("\n"))

    styles = [("\u201c\u201d", "\u2013", "\xa0", "\u2022"), ("\u201e\u201c", "\u2014", "\u3000", "\xb7"), ("\xab\xbb", "\u2011", "\u2009", "\u25e6"), ("\u300c\u300d", "\u2010", "\u202f", "\uf0b7")]
    assert license_ids(spark, [curly(t, *x) for _, t in license_texts.LICENSES for x in styles]) == [i for i, _ in license_texts.LICENSES for _ in styles]
    words = spark.createDataFrame([("Ünï-cödé ªº ²³ Ж 字々 한 ｶ",)], "t string").select(licenses.canonical(F.col("t"))).first()[0]
    assert words == "Ünï cödé ªº ²³ Ж 字々 한 ｶ"


def test_long_licenses(spark, tmp_path):
    """The query itself finds the whole texts that Debian ships, in any layout, and not parts of them."""
    files = {"Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0-Perl", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0"}
    files |= {"GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}
    folder = pathlib.Path("/usr/share/common-licenses")
    if not all((folder / f).exists() for f in files):
        pytest.skip("no licence texts")
    assert {i for i, _ in license_texts.DIGESTS} == set(files.values())
    rows = []
    for f, i in files.items():
        text = (folder / f).read_text(encoding="utf-8")
        terms, mark, _ = text.partition("END OF TERMS AND CONDITIONS")
        rows += [(x, i) for x in [text, *layouts(text), terms + mark, text.replace("[yyyy] [name of copyright owner]", "2020 Some One")]]
        rows += [(text + "\nand more", None), (text[: len(text) // 2], None)]
    spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["license_id"] for r in queries.op9_license_scan(spark, str(tmp_path)).collect()}
    assert [got[k] for k in range(len(rows))] == [i for _, i in rows]


def test_license_spellings_are_of_whole_words(spark):
    texts = ["The programmer's percentage of centred licences: sub-licensed, sub-\nlicensing", "licence licence Programmes WILFULLY non-commercial, COPYRIGHT\n * HOLDERS' organisations"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(licenses.canonical(F.col("t")).alias("c")).collect()
    assert [r["c"] for r in rows] == ["the programmer s percentage of centred licenses sublicensed sublicensing", "license license programs willfully noncommercial copyright owners organizations"]


def test_planted_licenses_by_query_and_sql(spark, tmp_path):
    """The query and its SQL agree on licences of all kinds among other texts."""
    rng = random.Random(9)
    texts, planted = [], []
    for i, t in license_texts.LICENSES:
        for notice in ("", "Copyright (c) 2020 X\n\n", "(c) 2001-2020 A\nCopyright 2021 B. All rights reserved.\n\n", "\u00a9 Copyright [yyyy] [name]\n"):
            for shape in (t, t.upper(), "\n".join("# " + x for x in textwrap.wrap(t, rng.randrange(40, 120), break_long_words=False)), t.replace('"', "\u201d").replace(" ", "\u00a0"), t.replace("license", "licence").replace("-", "\u2013")):
                texts.append(notice + shape)
                planted.append(i)
    n = len(texts)
    british = """relicenced sublicencees licencors sub-licensed abridgements judgement catalogues authorisations customiser emphasised initialising maximise minimises organisers realises recognised
        specialisation utilise analysed artefacts calibre centres cancelled labelling copyright-holders behaviours endeavoured favourably honours fulfilment merchantibility non commercially percent practising
        programmes whilst wilfully https"""
    texts += british.split() + [british, british.replace("\n", " * \n")]
    texts += ["x" + texts[rng.randrange(n)] for _ in range(40)] + [None, "", "word " * 400_000, "\x02\x06\x05 (c) 2020", "\u9fa5" * 100, "(c) 2020 a\n(c) 2021 b\nAuthorised programme, whilst judgements hon our Honours"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["text_digest"], r["license_id"]) for r in queries.op9_license_scan(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    exp = {r[0]: (r[1], r[2]) for r in con.execute(f"SELECT doc_id, text_digest, license_id FROM ({queries.oracle_sql()['op9_license_scan']})").fetchall()}
    assert [k for k in got if got[k] != exp[k]] == []
    assert [got[k][1] for k in range(n)] == planted and [got[k][1] for k in range(n, len(texts))] == [None] * (len(texts) - n)


def test_only_notices_are_dropped(spark):
    texts = ["Copyright (c) 2020 X\nCopyright holders may object.", "copyright notice and this permission", "Copyright (c) 2020 X. All rights reserved. Do not copy.", "Copyright (c) 2020 X " + "word " * 60]
    texts += ["Copyright (c) 2020 X\n\nSome prose of a document.\n\nReleased under the MIT License.", "a\n(c) You must retain all notices"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(licenses.canonical(F.col("t")).alias("c")).collect()
    assert [r["c"] for r in rows] == ["copyright owners may object", "copyright notice and this permission", "do not copy", "copyright c 2020 x " + "word " * 59 + "word", "some prose of a document released under the mit license", "a c you must retain all notices"]


# ── 10 ──────────────────────────────────────────────────────────────────────


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = list(zip(words, words[1:], words[2:], strict=False))
    seen = Counter(grams)
    hit = {x for i, g in enumerate(grams) if seen[g] > 1 for x in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_quality_counts_against_brute_force(spark, sf_dir):
    rng = random.Random(12)
    texts = ["".join(rng.choice(["a", "b", "c ", " ", "\n", "\t", "#", "é", "\x0b"]) for _ in range(rng.randrange(400))) for _ in range(150)] + ODD_TEXTS
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for rows in (list(enumerate(texts)), [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]):
        got = {r["doc_id"]: tuple(r[n] for n in names) for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == {i: brute_counts(t) for i, t in rows}


def test_quality_verdicts(spark, sf_dir):
    rows = queries.op10_quality_rules(spark, sf_dir).collect()
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["base_failed"] and r["kept"]) for r in rows)
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {q: [r["kept"] for r in rows if label.get(r["doc_id"]) == q and not r["base_failed"]] for q in (0, 1)}
    assert sum(kept[1]) >= 0.95 * len(kept[1]) and sum(kept[0]) <= 0.5 * max(1, len(kept[0]))
    assert quality.judge(odd_docs(spark)).count() == odd_docs(spark).count() and quality.judge(empty_docs(spark)).count() == 0


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(13)
    good = rng.random(20_000) < 0.7
    votes = np.stack([np.where(rng.random(20_000) < 0.3, 0, np.where(rng.random(20_000) < a, 1, -1) * np.where(good, 1, -1)) for a in (0.9, 0.9, 0.85, 0.8, 0.8, 0.9, 0.9, 0.9)], axis=1)
    patterns = sorted(Counter(map(tuple, votes.tolist())).items())
    prior, weights = quality.fit(patterns)
    odds = prior + sum(np.vectorize(w.get)(votes[:, j]) for j, w in enumerate(weights))
    assert ((odds > 0) == good).mean() > 0.97


# ── all: very long texts ────────────────────────────────────────────────────


def test_very_long_texts(spark, tmp_path):
    """Texts far above the batches' sizes, in whole: every operator gives what the same text gives in theory."""
    rng = random.Random(99)
    words = [f"w{rng.randrange(10**7)}x" for _ in range(300_000)]
    long, near = " ".join(words), " ".join([*words[:299_990], *"some other words at the end of this one copy".split()])
    item = " ".join(words[150_000:150_030])
    rows = [(1, long, "en", "a", 1), (2, near, "en", "a", 1), (3, long.upper(), "en", "b", 1), (4, prose(rng, 80), "en", "b", 1), (5, "short", "fr", None, 1)]
    docs = spark.createDataFrame(rows, DOC)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert len(long) > 2 << 20
    found = {r["doc_id"]: r for r in decontaminate.scan(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert [(s["start"], s["end"]) for s in found[3]["word_spans"]] == [(150_000, 150_030)] and not found[4]["word_spans"] and found[1]["n_words"] == 300_000
    spans = {(r["doc_id"], r["start_word"], r["end_word"]) for r in repeats.find_repeats(docs).collect()}
    assert spans == {(1, 0, 300_000), (2, 0, 299_990), (3, 0, 300_000)}
    left = {r["doc_id"]: r["text"] for r in repeats.remove_repeats(docs).collect()}
    assert left[1] == long and len(word_list(left[2])) == 10 and not word_list(left[3])
    classes = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs).collect()}
    assert classes == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}
    counted = {r["doc_id"]: (r["n_words"], r["n_repeat_words"]) for r in quality.judge(docs).collect()}
    assert counted[1] == (300_000, brute_counts(long)[4])
    assert {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, langid.collect_samples(docs)).collect()}.keys() == {1, 2, 3, 4, 5}
    mixed = {r["id"]: (r["size"], r["copies"]) for r in mixing.mix(docs).collect()}
    assert mixed[1][0] == 300_000 and all(n in (0, 1, 2) for _, n in mixed.values())
    assert {r["doc_id"]: r["size"] for r in queries.op4_sharding(spark, str(tmp_path)).collect()}[1] == len(long) + 1
    assert {r["license_id"] for r in queries.op9_license_scan(spark, str(tmp_path)).collect()} == {None}


# ── pipeline ────────────────────────────────────────────────────────────────


def test_pipeline_stages(spark, sf_dir, tmp_path):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_dedup", "decontamination", "mix_sources", "shard"]
    for k, (name, stage) in enumerate(cp.STAGES):
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if k < 4:
            assert after.columns == docs.columns
        ids = Counter(r["doc_id"] for r in after.collect())
        if name == "language_id":
            assert set(ids) == {i for i, t in before if any(map(str.isalpha, t or ""))}
        elif name == "near_dedup":
            assert ids == Counter(brute_classes(before).values()) & Counter(set(brute_classes(before).values()))
        elif name == "decontamination":
            bad = {r["doc_id"] for r in decontaminate.digests(decontaminate.scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))).where("contaminated").collect()}
            assert set(ids) == {i for i, _ in before} - bad and bad
        elif name == "mix_sources":
            words, total = {i: len((t or "").split()) for i, t in before}, sum(len((t or "").split()) for _, t in before)
            assert max(ids.values()) <= 2 and abs(sum(words[i] * n for i, n in ids.items()) - 1.5 * total) < 0.02 * total
        else:
            assert ids == Counter(i for i, _ in before)
        docs = after
    rows = docs.collect()
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows)
    assert cp.run(spark, sf_dir).count() == len(rows)


@pytest.mark.parametrize("make", [odd_docs, empty_docs])
def test_pipeline_stages_take_odd_rows(spark, sf_dir, make):
    import corpus_pipeline as cp

    docs = make(spark)
    columns = docs.columns
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != "shard":
            assert docs.columns == columns
    rows = docs.collect()
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows) and (rows or make is empty_docs)
