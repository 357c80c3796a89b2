"""Repeated passages by sparse suffix arrays.

A passage is at least ``MIN_WORDS`` words that stand in two documents. Every
window of that many words holds ``MIN_WORDS - K + 1`` runs of K words; the run
with the least hash, the leftmost of equals, is its minimiser. It depends on
the window's content alone, so copies of a window select the same place in it.

1. Suffixes are retained at minimisers only. With each goes the *block* of
   neighbouring windows that have selected it.
2. The suffixes are sorted by their first K words and then by their block (in
   hash order: all that matters is that equal ones become neighbours), over
   the whole corpus, and compared with their neighbours.
3. Where neighbours agree in the whole block, all its windows are repeated.
   Where they agree in the first words only, the match is extended left and
   right: each window of the block is looked up among those of the suffix's
   neighbours, by its hash. One suffix stands for all that have equal blocks,
   so a passage in a million documents costs one look-up, not a million.
4. Windows that overlap or touch are joined to maximal spans.

The result is exact but for collisions of 64-bit hashes: no cap, no sampling,
no pairs within a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import materialize
from .words import chunks, frugal, mix, _power, words_of

MIN_WORDS, K = 50, 12
#: Stands for a null id.
NO_ID = -(1 << 63)


class _Sums:
    """Hashes of runs of words from prefix sums."""

    def __init__(self, hashes: np.ndarray):
        self.up, self.down = _power(len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self.up[: len(hashes)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64)).view(np.int64)


def _argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each i the leftmost place of the least of values[i:i + width]."""
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        a, b = at[:-step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        have += step
    return at


def blocks_of(data: np.ndarray, offsets: np.ndarray, min_words: int = MIN_WORDS, k: int = K) -> dict[str, np.ndarray]:
    """The blocks of some texts: text, first and last window, hash of the first words and of the block, characters."""
    w = words_of(data, offsets)
    n = len(w.start)
    none = np.zeros(0, np.int64)
    if n < min_words:
        return dict.fromkeys(("text", "low", "high", "fp", "big", "char", "chars"), none)
    sums = _Sums(w.hashes())
    places = np.arange(n - k + 1)
    least = _argmin(sums.of(places, places + k).view(np.uint64), min_words - k + 1)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(w.first))
    s = np.arange(n - min_words + 1)
    s = s[text[s] == text[s + min_words - 1]]
    if not len(s):
        return dict.fromkeys(("text", "low", "high", "fp", "big", "char", "chars"), none)
    m = least[s]
    new = np.ones(len(s), bool)
    new[1:] = (m[1:] != m[:-1]) | (s[1:] != s[:-1] + 1) | (text[s[1:]] != text[s[:-1]])
    low = s[new]
    high = s[np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)]
    m, owner = m[new], text[low]
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    char = begins[w.start[low]]
    base = w.first[owner]
    return {
        "text": owner, "low": low - base, "high": high - base, "fp": sums.of(m, m + k), "big": sums.of(low, high + min_words),
        "char": char - begins[offsets[owner]], "chars": begins[w.end[high + min_words - 1]] - char,
    }


def _blocks(docs: DataFrame, min_words: int, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for a, _, data, offsets in chunks(batch.column(2)):
                x = blocks_of(data, offsets, min_words, k)
                rows = [x["fp"], x["big"], ids[a + x["text"]], x["low"] << 16 | (x["high"] - x["low"]), x["char"] << 32 | x["chars"], keys[a + x["text"]]]
                yield pa.RecordBatch.from_arrays([pa.array(r.astype(np.int64)) for r in rows], ["fp", "big", "doc", "at", "chars", "key"])

    return docs.mapInArrow(frugal(run), "fp long, big long, doc long, at long, chars long, key long")


def _compare(rows: list[np.ndarray], edge: bool) -> list[np.ndarray]:
    """Compare sorted suffixes with their neighbours; whole groups of equal first words.

    Gives those that are repeated or may be in part: doc, at, chars, key, first
    doc, last doc, whole (the block is repeated), extend (its windows are wanted).
    At an ``edge`` of a partition a group may go on in the next one, so
    everything in it is extended.
    """
    fp, big, doc, at, chars, key = rows
    n = len(fp)
    group = np.ones(n, bool)
    group[1:] = fp[1:] != fp[:-1]
    run = group.copy()
    run[1:] |= big[1:] != big[:-1]
    g0, r0 = np.flatnonzero(group), np.flatnonzero(run)
    g, r = np.cumsum(group) - 1, np.cumsum(run) - 1
    first, last = doc[r0], doc[np.append(r0[1:], n) - 1]  # documents are in order within a run
    runs = np.bincount(g[r0], minlength=len(g0))
    g_first, g_last = np.minimum.reduceat(doc, g0), np.maximum.reduceat(doc, g0)
    shared = (g_first != g_last) | edge
    whole = first != last
    extend = shared[g] & ((runs[g] > 1) | edge) & (~whole[r] | run)
    keep = (whole[r] & shared[g]) | extend
    return [x[keep] for x in (doc, at, chars, key, first[r], last[r], whole[r], extend)]


def _matches(blocks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        began = False

        def out(rows: list[np.ndarray], edge: bool):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _compare(rows, edge)], names)

        names = ["doc", "at", "chars", "key", "first", "last", "whole", "extend"]
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            fp = rows[0]
            cut = int(np.searchsorted(fp, fp[-1]))  # the last group may go on
            if cut or (held and held[-1][0][-1] != fp[0]):
                if held and held[-1][0][-1] == fp[0]:
                    stop = int(np.searchsorted(fp, fp[0], "right"))
                    held.append([x[:stop] for x in rows])
                else:
                    stop = 0
                if held:
                    yield out([np.concatenate(x) for x in zip(*held, strict=True)], not began)
                    began, held = True, []
                if cut > stop:
                    if not began:
                        stop = int(np.searchsorted(fp, fp[0], "right"))
                        yield out([x[:stop] for x in rows], True)
                        began = True
                    if cut > stop:
                        yield out([x[stop:cut] for x in rows], False)
            held.append([x[cut:] for x in rows])
        if held:
            yield out([np.concatenate(x) for x in zip(*held, strict=True)], True)

    schema = "doc long, at long, chars long, key long, first long, last long, whole boolean, extend boolean"
    ordered = blocks.repartitionByRange("fp", "big", "doc", "at").sortWithinPartitions("fp", "big", "doc", "at")
    return ordered.mapInArrow(frugal(run), schema)


def windows_of(data: np.ndarray, low: np.ndarray, high: np.ndarray, min_words: int) -> tuple[np.ndarray, ...]:
    """Of the windows low..high of one text: block, window, hash, first character, characters. Places beyond the text are left out."""
    w = words_of(data, np.array([0, len(data)]))
    high = np.minimum(high, len(w.start) - min_words)
    count = np.maximum(high - low + 1, 0)
    block = np.repeat(np.arange(len(low)), count)
    s = low[block] + np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    if not len(s):
        return block, s, s, s, s
    char = begins[w.start[s]]
    return block, s, _Sums(w.hashes()).of(s, s + min_words), char, begins[w.end[s + min_words - 1]] - char


def _windows(wanted: DataFrame, min_words: int) -> DataFrame:
    """Windows of the blocks to extend: hash, doc, at, chars, key, first, last, whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, key, text, blocks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                b = blocks.values.flatten()
                at, first, last, whole = (x.to_numpy(zero_copy_only=False) for x in b)
                data = np.frombuffer((text.as_py() or "").encode("utf-8", "replace"), np.uint8)
                block, s, hashed, char, chars = windows_of(data, at >> 16, (at >> 16) + (at & 0xFFFF), min_words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (hashed.astype(np.int64), np.full(len(s), doc, np.int64), s.astype(np.int64), (char << 32 | chars).astype(np.int64), np.full(len(s), key, np.int64), first[block], last[block], whole[block])],
                    ["hash", "doc", "at", "chars", "key", "first", "last", "whole"],
                )

    return wanted.mapInArrow(frugal(run), "hash long, doc long, at long, chars long, key long, first long, last long, whole boolean")


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """(doc, key, text) of each row and, for ids that are no integers, the ids by number.

    ``doc`` is the id (or its number, in order of a hash), ``key`` a hash of
    the text: together they are a row, or rows that are alike in all that counts.
    """
    i, text = F.col(id_col), F.col(text_col)
    if isinstance(docs.schema[id_col].dataType, T.IntegralType):
        return docs.select(F.coalesce(i.cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("key"), text.alias("text")), None
    ids = docs.select(i.alias("id")).distinct().repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first())
    ids = materialize(ids.withColumn("doc", F.monotonically_increasing_id()), "ids")
    rows = docs.select(i.alias("own"), F.xxhash64(text).alias("key"), text.alias("text"))
    return rows.join(ids, rows["own"].eqNullSafe(ids["id"])).select("doc", "key", "text"), ids


def _windows_found(slim: DataFrame, min_words: int, k: int) -> tuple[DataFrame, DataFrame]:
    """Runs of repeated windows (doc, key, low, high, chars, first): whole blocks, and single windows of other blocks.

    The second frame has the windows of whole blocks that were looked up as
    well, as ``first`` the least id that has the window in any block.
    """
    if not slim.groupBy("doc", "key").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        slim = materialize(slim.dropDuplicates(["doc", "key"]), "rows")  # else each copy's blocks would be looked up for all copies
    blocks = materialize(_blocks(slim, min_words, k), "blocks")
    matches = materialize(_matches(blocks), "matches")
    wanted = matches.where("extend").groupBy("doc", "key").agg(F.collect_list(F.struct("at", "first", "last", "whole")).alias("blocks"))
    windows = materialize(_windows(slim.join(wanted, ["doc", "key"]).select("doc", "key", "text", "blocks"), min_words), "windows")
    shared = windows.groupBy("hash").agg(F.min("first").alias("one"), F.max("last").alias("other")).where("one != other").select("hash", "one")
    shared = materialize(shared, "shared")
    looked_up = windows.join(shared, "hash").select("doc", "key", F.col("at").alias("low"), F.col("at").alias("high"), "chars", F.col("one").alias("first"), "whole")
    low = F.shiftright("at", 16)
    full = matches.where("whole").select("doc", "key", low.alias("low"), (low + F.col("at").bitwiseAND(F.lit(0xFFFF).cast("long"))).alias("high"), "chars", "first")
    return full.unionByName(looked_up.where("NOT whole").drop("whole")), looked_up.where("whole").drop("whole")


def _spans(runs: DataFrame, min_words: int) -> DataFrame:
    """Runs of windows that overlap or touch, joined to maximal spans."""
    char = F.shiftright("chars", 32)
    spans = runs.select("doc", "key", "low", (F.col("high") + min_words).alias("end"), char.alias("char"), (char + F.col("chars").bitwiseAND(F.lit(0xFFFFFFFF))).alias("char_end"), "first")
    order = Window.partitionBy("doc", "key").orderBy("low", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("low") <= F.col("before"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    spans = spans.withColumn("before", before).withColumn("island", island)
    return spans.groupBy("doc", "key", "island").agg(
        F.min("low").alias("start_word"), F.max("end").alias("end_word"), F.min("char").cast("long").alias("start_char"), F.max("char_end").cast("long").alias("end_char"), F.min("first").alias("first")
    )


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, k: int = K) -> DataFrame:
    """Maximal spans of repeated passages: (id, start_word, end_word, start_char, end_char, n_words, first_id).

    Words are runs of digits, ASCII letters (in any case) and non-ASCII
    characters. Word and character places count from 0, the end is exclusive;
    ``first_id`` is the least id found that has a part of the span (null is
    less than any). Rows with the same id count as one document, so what only
    they share is no repeat, but each row has its own spans; of rows that agree
    in id and text one is given. A null id is an id; ids may be of any type.
    Null, empty and short texts have no spans; an empty table gives no rows;
    other columns are not read.
    """
    slim, ids = _numbered(docs, id_col, text_col)
    runs, _ = _windows_found(slim, min_words, k)
    spans, first = _spans(runs, min_words), f"first_{id_col}"
    if ids is None:
        kind = docs.schema[id_col].dataType
        spans = spans.select(*(F.when(F.col(c) != NO_ID, F.col(c)).cast(kind).alias(n) for c, n in (("doc", id_col), ("first", first))), "start_word", "end_word", "start_char", "end_char")
    else:
        firsts = ids.select(F.col("id").alias(first), F.col("doc").alias("first"))
        spans = spans.join(ids.withColumnRenamed("id", id_col), "doc").join(firsts, "first")
    return spans.select(id_col, "start_word", "end_word", "start_char", "end_char", (F.col("end_word") - F.col("start_word")).alias("n_words"), first)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, k: int = K) -> DataFrame:
    """``docs`` without the passages that a document of a lesser id has, too; all rows and columns stay.

    A word goes if it lies in a window of ``min_words`` words that a lesser id
    has (null is less than any), so each passage stays where it stands first.
    Null texts stay null; a text may become empty; other rules as in
    :func:`find_repeats`.
    """
    slim, ids = _numbered(docs, id_col, text_col)
    runs, looked_up = _windows_found(slim, min_words, k)
    spans = _spans(runs.unionByName(looked_up).where(F.col("first") < F.col("doc")), min_words)
    cuts = spans.groupBy("doc", "key").agg(F.sort_array(F.collect_list(F.struct("start_char", "end_char"))).alias("cuts"))
    if ids is None:
        own = F.when(F.col("doc") != NO_ID, F.col("doc")).cast(docs.schema[id_col].dataType)
    else:
        cuts, own = cuts.join(ids, "doc"), F.col("id")
    tail = "_" * (1 + max(map(len, docs.columns)))
    cuts = cuts.select(own.alias(f"id{tail}"), F.col("key").alias(f"key{tail}"), F.col("cuts").alias(f"cuts{tail}"))
    rows = docs.withColumn(f"own{tail}", F.xxhash64(text_col))
    rows = rows.join(cuts, F.col(id_col).eqNullSafe(F.col(f"id{tail}")) & (F.col(f"own{tail}") == F.col(f"key{tail}")), "left")
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(f"cuts{tail}", lambda x: x["end_char"]))
    ends = F.concat(F.transform(f"cuts{tail}", lambda x: x["start_char"]), F.array(F.length(text_col).cast("long")))
    kept = F.zip_with(begins, ends, lambda a, b: F.substring(F.col(text_col), (a + 1).cast("int"), (b - a).cast("int")))
    return rows.withColumn(text_col, F.when(F.col(f"cuts{tail}").isNull(), F.col(text_col)).otherwise(F.array_join(kept, ""))).select(*docs.columns)
