"""Near-duplicate classes by BagMinHash.

A text is the multiset of its five-word shingles. Its signature has
``COMPONENTS`` minima of Poisson processes: each shingle owns a process on
(weight axis x time) for each dyadic interval of weights, 0..1, 1..2, 2..4 and
so on; a point counts if its weight lies below the shingle's weight in the
text, and goes to a component at random. Two signatures agree in a component
with a probability equal to the weighted Jaccard similarity.

Bands of the signatures propose pairs; the overlap of the multisets decides.
Classes are the connected components of the links. Within a bucket only a
leader, the member that meets most others over all bands, is compared with the
rest at first. Then members outside of the bucket's largest class are compared
with those of other classes, if their sizes, the number of shingles that no
other text has, and their sketches allow the similarity: no link between two
classes is lost, and pairs within a class are never made.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hashed, materialize, scratch
from .words import FOLD, chunks, frugal, mix, words_of

SHINGLE, SIMILARITY = 5, 0.8
#: Bands overlap: 36 disjoint ones fit into the components, and two orders of the components give 32 each.
COMPONENTS, BANDS, ROWS = 256, 64, 7
_CHOSEN = np.concatenate([np.random.RandomState(seed).permutation(COMPONENTS)[: BANDS // 2 * ROWS].reshape(-1, ROWS) for seed in (1, 2)])
#: One bit of each component makes a sketch. A pair at the threshold agrees in 230 of 256 bits, standard deviation
#: 4.8; pairs that agree in fewer than the least number are not compared (one true pair in 10**6).
SKETCH_WORDS, SKETCH_LEAST = 4, 206
#: Times that texts without a possible link are put aside before pairs are made.
NARROWINGS = 2
#: Parts of the hash space in which overlaps are bounded before pairs are made; a power of two.
PARTS = 64

_ONE = float(1 << 32)
_NEVER = np.int64((1 << 63) - 1)
_TABLE = bytes(int(x) or 32 for x in FOLD)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingles_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every five-word shingle; a text of one to four words is one shingle."""
    w = words_of(data, offsets)
    h, n = w.hashes(), np.diff(w.first)
    text = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(h))
    long = at[at + SHINGLE <= np.repeat(w.first[1:], n)]
    sums = np.zeros(len(long), np.uint64)
    for j, odd in enumerate(_ODD):
        sums += h[long + j] * odd
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    rest = np.zeros(len(short), np.uint64)
    for j, odd in enumerate(_ODD[:-1]):
        has = n[short] > j
        rest[has] += h[w.first[short[has]] + j] * odd
    rest += n[short].astype(np.uint64)
    texts, hashes = np.concatenate([text[long], short]), mix(np.concatenate([sums, rest]))
    order = np.lexsort((hashes, texts))
    return texts[order], hashes[order]


def _occurrence(texts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each sorted (text, hash) how many equal ones stand before it."""
    if not len(texts):
        return np.zeros(0, np.int64)
    new = np.ones(len(texts), bool)
    new[1:] = (texts[1:] != texts[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    return np.arange(len(texts)) - first[np.cumsum(new) - 1]


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(float) / (1 << 53) + 2.0**-54


def signatures(texts: np.ndarray, hashes: np.ndarray, n_texts: int, components: int = COMPONENTS) -> np.ndarray:
    """BagMinHash signatures (rows) of the multisets of sorted (text, hash); times are fixed-point numbers."""
    out = np.full(n_texts * components, _NEVER)
    if not len(texts):
        return out.reshape(n_texts, components)
    new = np.flatnonzero(_occurrence(texts, hashes) == 0)
    weight = np.diff(np.append(new, len(texts)))
    doc, key = texts[new], hashes[new]
    # interval 0 is [0, 1), interval i is [2**(i - 1), 2**i); an element has those that begin below its weight
    levels = np.ceil(np.log2(weight)).astype(np.int64) + 1
    task = np.repeat(np.arange(len(doc)), levels)
    level = np.arange(len(task)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    width = np.where(level > 0, low, 1.0)
    doc, top = doc[task], weight[task].astype(float)
    key = mix(key[task] + level.astype(np.uint64) * _ODD[1])
    time, points, done = np.zeros(len(task), np.int64), 1, 0
    limit = np.full(n_texts, _NEVER)
    while len(doc):
        j = np.arange(done, done + points, dtype=np.uint64) * _ODD[0]
        a = mix(key[:, None] + j[None, :])
        gaps = np.rint(-np.log(_uniform(a)) / width[:, None] * _ONE).astype(np.int64)
        at = time[:, None] + np.cumsum(gaps, axis=1)
        b = mix(a ^ _ODD[2])
        inside = low[:, None] + width[:, None] * _uniform(mix(b ^ _ODD[3])) < top[:, None]
        inside &= at < limit[doc][:, None]
        cell = doc[:, None] * components + (b % np.uint64(components)).astype(np.int64)
        np.minimum.at(out, cell[inside], at[inside])
        time, done, points = at[:, -1], done + points, min(points * 2, 64)
        here = np.unique(doc)
        limit[here] = out.reshape(n_texts, components)[here].max(axis=1)
        go = time < limit[doc]
        doc, key, low, width, top, time = (x[go] for x in (doc, key, low, width, top, time))
    return out.reshape(n_texts, components)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of each signature."""
    x = signature.view(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD[0], (len(x), BANDS))
    for j in range(ROWS):
        keys = mix(keys * _ODD[4] + x[:, _CHOSEN[:, j]])
    return keys.view(np.int64)


def sketches(signature: np.ndarray) -> np.ndarray:
    """A bit of each of the first components, as longs."""
    bits = mix(signature[:, : 64 * SKETCH_WORDS].view(np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8), axis=1).view(np.int64)


def node_of(text: bytes) -> int | None:
    """A 64-bit digest of a text's words; None without words. (Two of a billion texts share one with probability 0.03.)"""
    joined = b" ".join(text.translate(_TABLE).split())
    return int.from_bytes(hashlib.blake2b(joined, digest_size=8).digest(), "little", signed=True) if joined else None


def _nodes(data: np.ndarray, offsets: np.ndarray) -> list[int | None]:
    raw = data.tobytes()
    return [node_of(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _signed(docs: DataFrame) -> DataFrame:
    """(id, text_hash, node, bands) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column(2)):
                nodes = _nodes(data, offsets)
                texts, hashes = shingles_of(data, offsets)
                signature = signatures(texts, hashes, len(nodes))
                bands, bits = band_keys(signature), sketches(signature)
                size = np.bincount(texts, minlength=len(nodes))
                has = np.array([x is not None for x in nodes], bool)
                ends = np.concatenate([[0], np.cumsum(has * BANDS)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(bands[has].ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], batch.column(1)[a:b], pa.array(nodes, pa.int64()), lists, pa.array(size), *(pa.array(x) for x in bits.T)], names)

    words = [f"w{i}" for i in range(SKETCH_WORDS)]
    names = ["id", "text_hash", "node", "bands", "size", *words]
    return docs.mapInArrow(frugal(run), f"id {docs.schema['id'].dataType.simpleString()}, text_hash long, node long, bands array<long>, size long, {', '.join(f'{w} long' for w in words)}")


def _multisets(rows: DataFrame) -> DataFrame:
    """(node, shingles): equal shingles told apart by their number, so that set overlap is multiset overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column(1)):
                texts, hashes = shingles_of(data, offsets)
                own = mix(hashes + _occurrence(texts, hashes).astype(np.uint64) * _ODD[2]).view(np.int64)
                order = np.lexsort((own, texts))
                ends = np.searchsorted(texts, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.ListArray.from_arrays(pa.array(ends), pa.array(own[order]))], ["node", "shingles"])

    return rows.mapInArrow(frugal(run), "node long, shingles array<long>")


def _spread(rows: DataFrame) -> DataFrame:
    """(node, spread): how many of a text's shingles, but for its own ones, lie in each part of the hash space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            out = np.zeros(n * PARTS, np.int64)
            for c, sign in ((1, 1), (2, -1)):
                lists = batch.column(c)
                row = np.repeat(np.arange(n), lists.value_lengths().fill_null(0).to_numpy())
                out += sign * np.bincount(row * PARTS + (lists.flatten().to_numpy() & (PARTS - 1)), minlength=n * PARTS)
            ends = pa.array(np.arange(n + 1, dtype=np.int32) * PARTS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(out.astype(np.int32)))], ["node", "spread"])

    return rows.mapInArrow(frugal(run), "node long, spread array<int>")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted arrays without repeats."""
    if not len(a) or not len(b):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int(np.count_nonzero(b[at] == a))
    return both / (len(a) + len(b) - both)


def _verify(pairs: DataFrame, multisets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) whose multisets overlap enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for c in (2, 3):
                x = batch.column(c)
                sides.append((x.offsets.to_numpy(), x.values.to_numpy()))
            (ao, av), (bo, bv) = sides
            keep = [similarity(av[ao[i] : ao[i + 1]], bv[bo[i] : bo[i + 1]]) >= threshold for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    one = multisets.select(F.col("node").alias("u"), F.col("shingles").alias("s"))
    two = multisets.select(F.col("node").alias("v"), F.col("shingles").alias("t"))
    return pairs.join(one, "u").join(two, "v").select("u", "v", "s", "t").mapInArrow(frugal(run), "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of the connected components of ``links`` (u, v); the label is a node of the component.

    Each node points at its least neighbour, pointers are followed to their
    ends, and the ends are joined by what links are left between them, until
    there are none. All of it stays distributed.
    """
    edges, labels = links.select("u", "v"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        to = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("to")), "parents")
        while True:
            above = to.select(F.col("u").alias("to"), F.col("to").alias("above"))
            jumped = materialize(to.join(above, "to").select("u", F.col("above").alias("to"), (F.col("to") != F.col("above")).alias("moved")), "jumped")
            to = jumped.select("u", "to")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = to.select(F.col("u").alias("node"), F.col("to").alias("label"))
        else:
            labels = materialize(labels.join(to.withColumnsRenamed({"u": "label", "to": "next"}), "label", "left").select("node", F.coalesce("next", "label").alias("label")), "labels")
        edges = edges.join(to.withColumnsRenamed({"to": "a"}), "u").join(to.withColumnsRenamed({"u": "v", "to": "b"}), "v").where("a != b")
        edges = materialize(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "edges")
        if edges.isEmpty():
            return labels


def _once(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _repeats(rows: DataFrame) -> bool:
    """Whether rows agree in id and text: only then whole rows have to be sorted to keep one of each."""
    return not rows.groupBy("id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def _classes(slim: DataFrame, signed: DataFrame, threshold: float) -> DataFrame:
    """(node, label, class_id) of all nodes; written last of all tables."""
    # copies of the same words become one node; the row with the least id stands for it
    stands = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash"))
    words = [f"w{i}" for i in range(SKETCH_WORDS)]
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(stands.alias("row"), *(F.first(c).alias(c) for c in ("bands", "size", *words)))
    nodes = materialize(nodes.select("node", "row.id", "row.text_hash", "bands", "size", *words), "nodes")
    bands = nodes.select("node", F.explode("bands").alias("key"))
    sizes = materialize(bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    shared = materialize(bands.join(sizes, "key"), "shared")
    # a node that shares many buckets with many others is at the centre of its group
    rank = materialize(shared.groupBy("node").agg(F.struct(F.sum("n").alias("met"), "node").alias("rank")), "rank")
    shared = materialize(shared.join(rank, "node").select("key", "node", "rank"), "ranked")
    leaders = materialize(shared.groupBy("key").agg(F.max("rank").alias("leader")), "leaders")
    pairs = shared.join(leaders, "key").where("rank != leader").select(F.col("node").alias("u"), F.col("leader.node").alias("v"))
    pairs = materialize(_once(pairs), "pairs")
    proposed = shared.select("node").distinct().join(nodes.select("node", "id", "text_hash"), "node").select("node", F.col("id").alias("own_id"), F.col("text_hash").alias("own_hash"))
    texts = slim.join(hashed(proposed, rank.count()), F.col("id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")))
    texts = (texts.dropDuplicates(["own_id", "own_hash"]) if _repeats(signed) else texts).select("node", "text")
    multisets = materialize(_multisets(texts), "multisets")
    links = materialize(_verify(pairs, multisets, threshold), "links")
    labels = components(links)

    # members of a bucket that are in different classes still: those outside of its largest class are compared with
    # all of other classes, if their sizes, the shingles that only they have, and their sketches allow the similarity
    member = materialize(shared.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label")), "member")
    counts = member.groupBy("key", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("key").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("all"), F.count("*").alias("classes"))
    main = materialize(main.where("classes > 1 AND all > 2").select("key", F.col("main.label").alias("main")), "main")
    inside = materialize(member.join(main, "key"), "inside")
    # shingles that no other text in question has are no part of any overlap; a text with too many of them can't have
    # a link and is out of question, which may leave others alone with their shingles
    asked = inside.select("node").distinct().join(nodes.select("node", "size", *words), "node")
    for _ in range(NARROWINGS):
        own = asked.join(multisets, "node").select("node", F.explode("shingles").alias("shingle"))
        own = own.groupBy("shingle").agg(F.min("node").alias("node"), F.count("*").alias("n")).where("n = 1")
        own = materialize(own.groupBy("node").agg(F.count("*").alias("n"), F.collect_list("shingle").alias("own")), "own")
        asked = asked.drop("rest").join(own.select("node", "n"), "node", "left").withColumn("rest", F.col("size") - F.coalesce("n", F.lit(0))).drop("n")
        asked = materialize(asked.where(F.col("rest") >= threshold * F.col("size")), "asked")
    asked = asked.join(_spread(asked.join(multisets, "node").join(own, "node", "left").select("node", "shingles", "own")), "node")
    inside = inside.join(asked, "node").withColumn("step", F.floor(F.log("size") / -math.log(threshold)).cast("int"))
    inside = materialize(inside, "measured")
    # sizes within the threshold of each other are in the same step or in neighbouring ones
    a = inside.where("label != main").select("key", F.explode(F.array(F.col("step") - 1, F.col("step"), F.col("step") + 1)).alias("step"), *(F.col(c).alias(f"a_{c}") for c in ("node", "label", "size", "rest", "spread", *words)))
    b = inside.select("key", "step", (F.col("label") == F.col("main")).alias("b_main"), *(F.col(c).alias(f"b_{c}") for c in ("node", "label", "size", "rest", "spread", *words)))
    agree = F.lit(64 * SKETCH_WORDS)
    for w in words:
        agree = agree - F.bit_count(F.col(f"a_{w}").bitwiseXOR(F.col(f"b_{w}")))
    most = F.least("a_rest", "b_rest")
    once = F.col("b_main") | (F.col("a_node") < F.col("b_node"))
    total = F.col("a_size") + F.col("b_size")
    fits = once & (F.col("a_label") != F.col("b_label")) & (most >= threshold * (total - most)) & (agree >= SKETCH_LEAST)
    # the overlap within each part of the hash space is bounded too
    most = F.aggregate(F.zip_with("a_spread", "b_spread", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    fits = fits & (most >= threshold * (total - most))
    a, b = a.alias("a"), b.alias("b")
    more = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.step") == F.col("b.step")) & fits).select(F.col("a_node").alias("u"), F.col("b_node").alias("v"))
    more = materialize(_once(more).join(pairs, ["u", "v"], "left_anti"), "more")
    if not more.isEmpty():
        found = materialize(_verify(more, multisets, threshold), "found")
        if not found.isEmpty():
            labels = components(links.unionByName(found))

    label = F.coalesce("label", "node")
    labelled = nodes.select("node", "id").join(labels, "node", "left").select("node", "id", label.alias("label"))
    labelled = materialize(labelled, "labelled")
    least = materialize(labelled.groupBy("label").agg(F.min("id").alias("class_id")), "least")
    return materialize(labelled.join(least, "label").select("node", "label", "class_id"), "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row (id, class_id, class_node, text_hash) for each row of ``docs``.

    ``class_id`` is the least id of the documents that links join, exact copies
    (of the words) included. A text without words, or a null one, is a class by
    itself: its class_id is its id. A null id takes part; a class of null ids
    only has a null class_id. Repeated rows are copies. An empty table gives no
    rows; other columns are not read.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    signed = materialize(_signed(slim), "signed")
    with scratch(docs.sparkSession) as keep:
        classes = keep(_classes(slim, signed, threshold))
    out = signed.select("id", "text_hash", "node").join(classes, "node", "left")
    alone = F.col("node").isNull()
    return out.select(F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.col("label").alias("class_node"), "text_hash")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class, the one with the least id, all columns kept.

    Texts without words are classes by themselves; of repeated rows one stays.
    Of a class of null ids one row stays.
    """
    tail = "_" * (1 + max(map(len, docs.columns)))
    own, own_hash = f"id{tail}", f"hash{tail}"
    found = near_duplicates(docs, id_col, text_col, threshold).select(F.col(id_col).alias("id"), "class_id", "class_node", "text_hash")
    repeated = _repeats(found)
    found = found.where(F.col("id").eqNullSafe(F.col("class_id")))
    of_class = found.where("class_node IS NOT NULL").groupBy("class_node").agg(F.min(F.struct("id", "text_hash")).alias("row")).select("row.id", "row.text_hash")
    alone = found.where("class_node IS NULL").select("id", "text_hash").distinct()
    kept = materialize(of_class.unionByName(alone).select(F.col("id").alias(own), F.col("text_hash").alias(own_hash)), "kept")
    rows = docs.join(hashed(kept, kept.count()), F.col(id_col).eqNullSafe(F.col(own)) & (F.xxhash64(text_col) == F.col(own_hash)))
    return (rows.dropDuplicates([own, own_hash]) if repeated else rows).select(*docs.columns)
