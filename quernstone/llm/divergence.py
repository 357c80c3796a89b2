"""How far the sources of a language differ from each other in their words.

Each language keeps the terms that stand in at least ``MIN_DOCS`` of its
documents; each of its sources, and the language itself, gives each kept term a
smoothed probability in billionths. Two sources differ by the triangular
discrimination, the sum over all kept terms of (p - q)**2 / (p + q), each term
rounded down; a source's most telling terms are those that it uses more than
its language does, by the same measure. All of it is integer arithmetic.

1. Each task encodes the terms of its texts by a dictionary and counts them by
   ``bincount``, so a shuffle sees a term once for each source and megabytes of
   text, however often a hot source repeats it.
2. The counts of kept terms are dealt out in chunks of a language's vocabulary,
   at most about ``CELLS`` counts each. A chunk's kept terms are a sorted array
   (in UTF-8 order); ``searchsorted`` gives their ids, and one ``bincount``
   gives the dense vectors of all sources. Equal values are in order of the
   ids, so ties are settled by the terms themselves.
3. The chunks' sums and best terms are added up and ranked by Spark.

No task holds a vocabulary, a language or a source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, scratch
from .words import chunks, frugal

MIN_DOCS, TOP_TERMS = 10, 10
#: Probabilities are in parts of this number; each term counts so many times more than it stands there: fixed values.
ONE, EXTRA = 1_000_000_000, 2
#: Counts in a chunk of a vocabulary: what one step holds at a time, eight bytes each.
CELLS = 1 << 16
#: Bytes of text that are counted at a time.
CHUNK_BYTES = 4 << 20

#: Byte to byte: letters (A-Z as a-z) and bytes of non-ASCII characters stay, the rest is 0.
FOLD = np.zeros(256, np.uint8)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(text, term) of every occurrence; terms as a dictionary array."""
    folded = FOLD[data]
    inside = folded != 0
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = ~inside[:-1]
    edge[offsets] = True
    begin = np.flatnonzero(inside & edge[:-1])
    after = np.ones(len(data) + 1, bool)
    after[:-1] = ~inside
    after[offsets] = True
    end = np.flatnonzero(inside & after[1:]) + 1
    kept = np.ascontiguousarray(folded[inside])
    at = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(at), pa.py_buffer(kept)])
    return np.searchsorted(offsets, begin, "right") - 1, column.dictionary_encode()


def _names(columns: list[pa.Array]) -> tuple[np.ndarray, list[pa.Array]]:
    """The number of each row's group, and the groups' names (nulls are empty)."""
    filled = [c.fill_null("") for c in columns]
    codes, names = np.zeros(len(filled[0]), np.int64), []
    for c in filled:
        d = c.dictionary_encode()
        codes = codes * max(1, len(d.dictionary)) + d.indices.to_numpy(zero_copy_only=False)
        names.append(c)
    _, first, group = np.unique(codes, return_index=True, return_inverse=True)
    return group, [c.take(pa.array(first)) for c in names]


def _counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, docs, n) of some megabytes of text each; a group also has a row without a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column(2), CHUNK_BYTES):
                group, names = _names([batch.column(i)[a:b] for i in (0, 1)])
                text, terms = terms_of(data, offsets)
                width = max(1, len(terms.dictionary))
                ids = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                key, n = np.unique(group[text] * width + ids, return_counts=True)
                once = np.unique(text * width + ids)
                in_docs = np.bincount(np.searchsorted(key, group[once // width] * width + once % width), minlength=len(key))
                groups = np.arange(len(names[0]))
                owner = pa.array(np.concatenate([key // width, groups]))
                term = pa.concat_arrays([terms.dictionary.take(pa.array(key % width)).view(pa.large_string()).cast(pa.string()), pa.nulls(len(groups), pa.string())])
                none = np.zeros(len(groups), np.int64)
                counts = [pa.array(np.concatenate([x.astype(np.int64), none])) for x in (in_docs, n)]
                yield pa.RecordBatch.from_arrays([names[0].take(owner), names[1].take(owner), term, *counts], ["lang", "source", "term", "docs", "n"])

    return docs.mapInArrow(frugal(run), "lang string, source string, term string, docs long, n long")


def parts_of(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(ONE * counts / total), exact for counts up to 10**14: the product is formed in two steps."""
    a, b = 31_250, ONE // 31_250
    q, r = np.divmod(counts * a, total)
    return 1 + q * b + r * b // total


def _compared(counts: DataFrame, top_terms: int) -> DataFrame:
    """(lang, source, part, item, value) of each chunk: sums of pairs of sources over its terms, and the best terms of each source.

    ``counts`` has lang, chunk, source, term, n; a row without a term gives a
    source's total in ``n`` and the number of terms of the language in ``v``.
    """
    names = ["lang", "source", "part", "item", "value"]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = {c: table.column(c).combine_chunks() for c in ("source", "term", "n", "v")}
        head = rows["term"].is_null()
        source, term = (rows[c].cast(pa.binary()).to_numpy(zero_copy_only=False) for c in ("source", "term"))
        n, is_head = rows["n"].to_numpy(), head.to_numpy(zero_copy_only=False)
        order = np.argsort(source[is_head])
        sources, totals = source[is_head][order], n[is_head][order]
        v = int(rows["v"].to_numpy(zero_copy_only=False)[is_head][0])
        terms = np.unique(term[~is_head])
        ids, width, many = np.searchsorted(terms, term[~is_head]), len(terms), len(sources)
        found: list[tuple[np.ndarray, str, np.ndarray, np.ndarray]] = []
        if width:
            at = np.searchsorted(sources, source[~is_head]) * width + ids
            cells = np.bincount(at, weights=n[~is_head], minlength=many * width).astype(np.int64).reshape(many, width)
            p = parts_of(cells + EXTRA, totals[:, None] + EXTRA * v)
            q = parts_of(cells.sum(0) + EXTRA, totals.sum() + EXTRA * v)
            f = (p - q) ** 2 // (p + q)
            for i in range(many):
                able = np.flatnonzero((cells[i] > 0) & (p[i] > q))
                best = able[np.argsort(-f[i, able], kind="stable")][:top_terms]  # ids are in the terms' order
                found.append((sources[i], "term", terms[best], f[i, best]))
        for i in range(many):
            others = np.flatnonzero(np.arange(many) != i)
            value = ((p[i] - p[others]) ** 2 // (p[i] + p[others])).sum(1) if width else np.zeros(len(others), np.int64)
            found.append((sources[i], "pair", sources[others], value))
        sizes = [len(x[3]) for x in found]
        columns = [
            pa.array([key[0].as_py()] * sum(sizes), pa.string()),
            pa.array(np.repeat(np.array([x[0] for x in found], object), sizes), pa.binary()).cast(pa.string()),
            pa.array(np.repeat(np.array([x[1] for x in found], object), sizes), pa.string()),
            pa.array(np.concatenate([x[2] for x in found]), pa.binary()).cast(pa.string()),
            pa.array(np.concatenate([x[3] for x in found]).astype(np.int64)),
        ]
        return pa.Table.from_arrays(columns, names)

    return counts.groupBy("lang", "chunk").applyInArrow(run, "lang string, source string, part string, item string, value long")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, cells: int = CELLS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from the others, and its most telling terms.

    Part ``pair`` has every other source of the language as item and the
    divergence as value; part ``term`` the terms that the source uses more than
    the language does, ``top_terms`` at most. Ranks count from 1, by value
    descending and item ascending (in UTF-8). Nulls are empty strings, so a
    null language or source is one without a name. Texts without terms count
    for their source all the same; a language that keeps no term has pairs of
    value 0; one with a single source has no pairs. Repeated rows are documents
    of their own. An empty table gives no rows; other columns are not read.
    """
    slim = docs.select(F.coalesce(lang_col, F.lit("")).alias("lang"), F.coalesce(source_col, F.lit("")).alias("source"), F.col(text_col).alias("text"))
    with scratch(docs.sparkSession) as keep:
        counts = _counted(slim).groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
        counts = materialize(counts, "counts")
        kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
        counts_kept = materialize(counts.join(kept.select("lang", "term"), ["lang", "term"]).select("lang", "source", "term", "n"), "kept")
        groups = counts.where("term IS NULL").select("lang", "source")
        totals = groups.join(counts_kept.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
        langs = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(counts_kept.groupBy("lang").agg(F.count_distinct("term").alias("v")), "lang", "left")
        langs = langs.select("lang", F.coalesce("v", F.lit(0)).alias("v"), "sources")
        langs = materialize(langs.withColumn("chunks", F.greatest(F.lit(1), F.ceil(F.col("v") * F.col("sources") / cells)).cast("int")), "langs")
        chunk = F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int")
        rows = counts_kept.join(langs, "lang").select("lang", chunk.alias("chunk"), "source", "term", "n", F.lit(None).cast("long").alias("v"))
        heads = totals.join(langs, "lang").select("lang", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "source", F.lit(None).cast("string").alias("term"), F.coalesce("n", F.lit(0)).alias("n"), "v")
        found = keep(materialize(_compared(rows.unionByName(heads), top_terms), "compared"))
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    return pairs.select("lang", "source", "part", "item", "value", "rank").unionByName(terms.select("lang", "source", "part", "item", "value", "rank"))
