"""Source divergence, conversation repair and near vectors against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quernstone.llm import decontaminate, divergence, embeddings, queries, repair

DOC = "doc_id long, text string, lang string, source string, n_chars long"


# ── 11 ──────────────────────────────────────────────────────────────────────


def brute_audit(rows, min_docs=10, top=10):
    upper = {i: i + 32 for i in range(65, 91)}
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        w = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(upper))
        docs[lang].update(set(w))
        counts[lang, source].update(w)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def parts(of):
            n = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 2) // (n + 2 * len(kept)) for t in kept}

        whole = parts(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: parts(counts[lang, s]) for s in sources}
        for s in sources:
            pair = [(o, sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, (p[s][t] - whole[t]) ** 2 // (p[s][t] + whole[t])) for t in kept if counts[lang, s][t] and p[s][t] > whole[t]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return sorted(out)


def odd_corpus(rng, n=900):
    """Sources of very different sizes (one holds half), null and clashing names, ties, texts without terms, one very long text."""
    words = ["alpha", "Béta", "GAMMA", "delta", "ÉPSILON", "zeta", "eta", "漢字", "z", "Z"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 8 + ["a", "b", None, "", "é"])
        k = int(rng.random() ** 2 * 40)
        rows.append((" ".join(rng.choice(words[: 20 + 30 * (i % 9)]) for _ in range(k)) + rng.choice(["", "!", "\n1 2"]), rng.choice(["en", "fr", None]), source))
    rows += [(None, "en", "empty"), ("", "en", "empty"), ("12 34", "xx", "alone"), ("12", "xx", "other"), ("alpha " * 50_000, "en", "a"), ("alpha " * 50_000, "en", "a")]
    return rows


@pytest.mark.parametrize("cells", [1, 64, divergence.CELLS])
def test_audit_against_brute_force(spark, cells):
    rows = odd_corpus(random.Random(3))
    docs = spark.createDataFrame([(i, *r, 1) for i, r in enumerate(rows)], DOC).withColumns({c: F.lit(1) for c in ("term", "n", "chunk", "docs", "v", "rank")})
    assert sorted(map(tuple, divergence.audit(docs, cells=cells).collect())) == brute_audit(rows)


def test_parts_are_exact_for_large_counts():
    rng = random.Random(1)
    for _ in range(300):
        total = rng.randrange(1, 2 * 10**14)
        count = rng.randrange(0, total)
        assert divergence.parts_of(np.array([count]), np.array([total]))[0] == 1 + 10**9 * count // total


def test_terms_end_with_their_texts(spark):
    data = "aB c1Dé|x".encode()
    text, terms = divergence.terms_of(np.frombuffer(data, np.uint8), np.array([0, 2, 2, len(data)]))
    assert text.tolist() == [0, 2, 2, 2] and [terms.dictionary[i].as_py().decode() for i in terms.indices.to_pylist()] == ["ab", "c", "dé", "x"]


def test_audit_of_an_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], DOC)).count() == 0


# ── 12 ──────────────────────────────────────────────────────────────────────


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def brute_repair(rows):
    """The rows of one conversation: the contract, with audits carried along as strings."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        ink = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
        seen.add((role, text))
    states = {"": (0, "", [])}  # by the initials that stand so far, cut to the last: the cheapest, then first, way
    grow = {"": "u", "s": "u", "u": "a", "a": "u"}

    def offer(into, state, cost, audit, lines):
        if state not in into or (cost, audit) < into[state][:2]:
            into[state] = (cost, audit, lines)

    def inserted(states):
        out = dict(states)
        for _ in range(3):
            for s, (cost, audit, lines) in list(out.items()):
                t = grow[s]
                offer(out, t, cost + 5, audit + "I", lines + [{"u": "user:", "a": "assistant:"}[t]])
        return out

    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        # every number of insertions is tried by itself, as a cheaper way to a state may be worse as a string later
        layer = [(s, *v) for s, v in states.items()]
        for _ in range(3):
            for s, cost, audit, lines in layer:
                offer(new, s, cost + 2, audit + "D", lines)
                if fault not in ("blank", "duplicate"):
                    late, t = 5 * (fault == "truncated"), grow[s]
                    offer(new, t, cost + 1 + late, audit + "R", lines + [{"u": "user", "a": "assistant"}[t] + ":" + text])
                    if role[:1] == t or (role[:1] == "s" and s == ""):
                        offer(new, role[:1], cost + late, audit + "K", lines + [f"{role}:{text}"])
            layer = [(grow[s], cost + 5, audit + "I", lines + [{"u": "user:", "a": "assistant:"}[grow[s]]]) for s, cost, audit, lines in layer]
        states = new
    ends = [v for s, v in inserted(states).items() if s in ("", "a")]
    cost, audit, lines = min(ends, key=lambda x: x[:2])
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_repairs(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    return {c: brute_repair(x) for c, x in by.items()}


ROW = "conv_id long, turn long, role string, text string"


def odd_conversations(rng, n=250):
    roles = ["user", "assistant", "system", "tool", "", None, "ua", "u", "Assistant"]
    texts = ["Yes.", "no", "", " \n", "Why?  ", "go!\t", None, "é", "stop. ", "a:b\n.", "user:"]
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, 12)):
            rows.append((c if c else None, rng.choice([t, t, t, t + 1, None, t // 2]), rng.choice(roles[: rng.choice([2, 3, 9])]), rng.choice(texts[: rng.choice([3, 11])])))
    return rows + rows[:40]


@pytest.mark.parametrize("block", [1, 4, repair.BLOCK])
def test_repair_against_brute_force(spark, block):
    rows = odd_conversations(random.Random(block))
    table = spark.createDataFrame(rows, ROW).withColumns({c: F.lit(1) for c in ("pos", "kind", "cost", "block", "fault", "first")})
    damaged = repair.damage(table)
    assert Counter(map(tuple, damaged.collect())) == Counter(brute_damage(rows))
    want = brute_repairs(brute_damage(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r[0]: tuple(r[1:]) for r in repair.with_all(repair.repair(damaged, block), table).collect()}
    assert got == {c: want.get(c, nothing) for c in {r[0] for r in rows}}


def test_repair_of_plain_rows_and_empty_tables(spark):
    rows = [r for r in odd_conversations(random.Random(9)) if None not in r[2:]]
    got = {r[0]: tuple(r[1:]) for r in repair.repair(spark.createDataFrame(rows, ROW)).collect()}
    assert got == brute_repairs(rows)
    assert repair.repair(spark.createDataFrame([], ROW)).count() == 0
    empty = spark.createDataFrame([], ROW)
    assert repair.with_all(repair.repair(repair.damage(empty)), empty).count() == 0


def test_one_long_conversation_is_chained_over_blocks(spark):
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", "", f"{t}!"])) for t in range(3000)] + [(2, 0, "user", "x" * 500_000 + ".")]
    got = {r[0]: tuple(r[1:]) for r in repair.repair(spark.createDataFrame(rows, ROW), block=64).collect()}
    assert got == brute_repairs(rows)


def test_macros_are_a_prefix_free_code_in_order():
    assert repair.MACROS == sorted(repair.MACROS) and not any(a != b and b.startswith(a) for a in repair.MACROS for b in repair.MACROS)


# ── 13 ──────────────────────────────────────────────────────────────────────


def brute_links(rows, threshold=0.93):
    """[(id, n_links, component_id, kept)] of rows (id, vector, label)."""
    n, edges = len(rows), defaultdict(set)

    def fine(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = [embeddings.units(np.array([v], float))[0] if fine(v, l) else None for _, v, l in rows]
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                edges[i].add(j)
                edges[j].add(i)
    out = []
    for i in range(n):
        reach, todo = {i}, [i]
        while todo:
            new = edges[todo.pop()] - reach
            reach |= new
            todo += new
        ids = [rows[k][0] for k in reach if rows[k][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(edges[i]), least, least == rows[i][0]))
    return Counter(out)


VECTOR = "vec_id long, embedding array<{}>, label int"


def clustered(rng, dim, n=260):
    rows = []
    centres = rng.normal(size=(6, dim))
    for i in range(n):
        c = centres[min(5, int(rng.exponential(1.2)))]
        rows.append((i, (c / np.linalg.norm(c) + rng.normal(size=dim) * rng.choice([0.05, 0.3, 0.6]) / np.sqrt(dim)).tolist(), int(rng.integers(0, 2))))
    chain = [(1000 + i, [float(np.cos(i * 0.36)), float(np.sin(i * 0.36))] + [0.0] * (dim - 2), 5) for i in range(9)]
    return rows + chain


@pytest.mark.parametrize("dim", [2, 8, 64])
@pytest.mark.parametrize("block", [16, embeddings.BLOCK])
def test_near_vectors_against_brute_force(spark, dim, block):
    rows = clustered(np.random.default_rng(dim), dim)
    got = Counter(map(tuple, embeddings.near_vectors(spark.createDataFrame(rows, VECTOR.format("double")), block=block).collect()))
    assert got == brute_links(rows)


def test_near_vectors_odd_rows(spark):
    v, inf, nan = [1.0, 2.0, 3.0], float("inf"), float("nan")
    rows = [(1, v, 1), (2, v, 1), (2, v, 1), (3, v, None), (4, v, 2), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (7, [0.0, -0.0, 0.0], 1), (8, [1.0, None, 3.0], 1), (9, [1.0, nan, 3.0], 1), (10, [inf, 1.0, 1.0], 1)]
    rows += [(None, [10.0, 20.0, 30.0], 1), (None, [5.0, -5.0, 0.0], 1), (11, [1.0, 2.0], 1), (12, [2.0, 4.1], 1), (13, [1e200, 2e200, 3e200], 3), (14, [1e-300, 2e-300, 3e-300], 3), (15, [3.0], 4), (16, [5.0], 4), (17, [-1.0], 4)]
    table = spark.createDataFrame(rows, VECTOR.format("double")).withColumns({c: F.lit(1) for c in ("node", "n_links", "kept", "group", "copies", "vector", "id")})
    assert Counter(map(tuple, embeddings.near_vectors(table).collect())) == brute_links(rows)
    assert embeddings.near_vectors(spark.createDataFrame([], VECTOR.format("float"))).count() == 0
    none = spark.createDataFrame([(1, None, None), (None, None, 1)], VECTOR.format("float"))
    assert Counter(map(tuple, embeddings.near_vectors(none).collect())) == Counter([(1, 0, 1, True), (None, 0, None, True)])


def test_dense_group_is_counted_without_its_pairs(spark):
    """2,000 near copies of one vector, 500 exact ones, and some at the edge of the group."""
    rng = np.random.default_rng(1)
    c = rng.normal(size=32)
    c /= np.linalg.norm(c)
    rows = [(i, (c + rng.normal(size=32) * 0.01).tolist(), 0) for i in range(2000)] + [(3000 + i, c.tolist(), 0) for i in range(500)]
    side = rng.normal(size=32)
    side -= (side @ c) * c
    side /= np.linalg.norm(side)
    rows += [(5000 + i, (np.cos(a) * c + np.sin(a) * side).tolist(), 0) for i, a in enumerate(np.linspace(0.2, 0.7, 40))]
    got = Counter(map(tuple, embeddings.near_vectors(spark.createDataFrame(rows, VECTOR.format("double")), block=128).collect()))
    x = embeddings.units(np.array([r[1] for r in rows]))
    degree = (x @ x.T >= 0.93).sum(1) - 1
    assert sorted((r[0], r[1]) for r in got.elements()) == [(r[0], d) for r, d in zip(rows, degree.tolist(), strict=True)]


@pytest.mark.parametrize("dim", [3, 16, 64, 300])
def test_recall_at_the_threshold(dim):
    """Pairs at the threshold exactly, of which fresh ones are missed by 0.5 % at most."""
    rng = np.random.RandomState(99)
    x, z = rng.normal(size=(2, 3000, dim))
    x = embeddings.units(x)
    z = embeddings.units(z - (z * x).sum(1)[:, None] * x)
    code = embeddings.codes(dim, 0.93)
    assert embeddings.shared_filter(code.filters(x), code.filters(0.93 * x + np.sqrt(1 - 0.93**2) * z)).mean() >= 0.995


def test_planted_rows_by_queries_and_sql(spark, tmp_path):
    """The three queries and their SQL over tables with odd rows."""
    import duckdb

    rng = random.Random(5)
    spark.createDataFrame([(i, *r, 1) for i, r in enumerate(odd_corpus(rng, 300))], DOC).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(odd_conversations(rng, 80), ROW).write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame(clustered(np.random.default_rng(2), 16), VECTOR.format("float")).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    for name in ("op11_source_divergence", "op12_conversation_repair", "op13_embedding_near_dedup"):
        got = queries.queries()[name](spark, str(tmp_path))
        cols = sorted(got.columns)
        want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.oracle_sql()[name]})").fetchall()
        assert Counter(map(tuple, got.select(*cols).collect())) == Counter(want), name


# ── 2 ───────────────────────────────────────────────────────────────────────


@pytest.mark.parametrize(("letters", "window"), [(2, 13), (3, 5), (30, 13), (2, 1)])
def test_automaton_over_word_numbers(letters, window):
    """Few words make many failure links; long texts cross many lanes; items and texts share no words but by chance."""
    rng = random.Random(letters)

    def some(n):
        return " ".join(f"w{rng.randrange(letters)}" for _ in range(n))

    items = tuple((rng.choice([None, str(k)]), some(rng.choice([0, 1, 3, window, 40]))) for k in range(12))
    texts = [some(n) for n in (0, 1, 2, 127, 128, 129, 1000)] + [None, "?!", some(500) + " other " + items[3][1].upper() + " Other"]
    found = list(decontaminate.hits(pa.array(texts), decontaminate.automaton(items, window)))
    for text, (n, spans, ids) in zip(texts, found, strict=True):
        words = re.findall("[0-9a-z]+", (text or "").lower())
        hit, expected = set(), set()
        for item_id, item in items:
            w = item.split()
            size = min(window, len(w))
            grams = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if w else set()
            at = [k for k in range(len(words) - size + 1) if tuple(words[k : k + size]) in grams]
            hit.update(x for k in at for x in range(k, k + size))
            expected.update([item_id] if at else [])
        assert (n, {x for a, b in spans for x in range(a, b)}, ids) == (len(words), hit, expected)
        assert all(b < c for (_, b), (c, _) in itertools.pairwise(spans))


def test_automaton_is_small():
    """A node takes 14 bytes, so a megabyte of items with no common windows takes less than 40 MB."""
    rng = random.Random(3)
    items = tuple((str(k), " ".join(f"{rng.randrange(30000):05x}" for _ in range(170))) for k in range(1000))
    machine = decontaminate.automaton(items, 13)
    assert sum(x.nbytes for x in machine if hasattr(x, "nbytes")) < 40e6
    ((n, spans, ids),) = decontaminate.hits(pa.array([items[7][1] + " x " + items[9][1][6:]]), machine)
    assert (n, spans, ids) == (340, [(0, 170), (171, 340)], {"7", "9"})
