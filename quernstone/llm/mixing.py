"""Mixing sources to target weights by pivotal dependent rounding.

A source's rate is its target over its size; each of its documents is to be
taken ``rate`` times on average. The whole part is certain. The fractional
parts are rounded by the pivotal method: two documents with fractions, or a
document and the pool of those after it, swap mass, one up and one down, at
random and without bias, so that the words taken stay the same, until one of
the two is 0 or 1. What is left of a bucket of
documents, at most one fraction, goes up a reduction tree to be paired with
what other buckets left; the last fraction of a source is decided by chance.
So a source's words miss its target by less than one of its small documents,
unless one document outweighs all smaller ones of its bucket.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import hashed, materialize

#: Weights of the sources in code-point order, repeating; null comes last.
WEIGHTS = (5, 2, 1)
#: Words in the mix over words in all; most times that a document is taken.
SHARE, MOST = 1.5, 2
#: Documents of a bucket, about, and buckets whose remainders meet in one at the next level.
BUCKET_ROWS, FAN_IN = 2048, 1024
#: Sources that one task puts in order.
SOURCES_AT_ONCE = 1 << 16
#: Repeated rows are made out of their number in runs of so many.
RUN = 4096
SEED = 20240229


def count_words(text: Column) -> Column:
    """The number of runs of other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _before(rows: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with the sum of each of ``sums`` over the rows before, in an order, in parallel: ranges are summed up first."""
    ranged = materialize(rows.withColumns(sums).repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("range").agg(*(F.sum(c).alias(c) for c in sums)).select("range", *(F.sum(c).over(earlier).alias(f"{c}_0") for c in sums))
    within = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.withColumns({c: F.coalesce(F.sum(c).over(within), F.lit(0)) for c in sums}).join(totals, "range")
    return out.select(*rows.columns, *((F.col(c) + F.coalesce(F.col(f"{c}_0"), F.lit(0))).alias(c) for c in sums))


def source_targets(sizes: DataFrame, at_once: int = SOURCES_AT_ONCE) -> DataFrame:
    """(source, source_size, n_docs, target) from a row (source, size) for each document; no documents: no rows.

    The targets fill up by weight: a source stops at ``MOST`` times its size
    and its excess is shared by weight among the others. That is the level
    ``x`` with ``sum(min(MOST * size, weight * x)) = SHARE * sum(size)``, found
    over the sources in the order in which they fill. Only one row for each
    source takes part; up to ``at_once`` of them are put in order by one task,
    more by ranges.
    """
    s = materialize(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")), "sources")
    of = s.agg(F.count("*").alias("n"), F.sum("source_size").alias("words")).first()
    few = of["n"] <= at_once
    by_name = [F.col("source").asc_nulls_last()]
    if few:
        s = s.withColumn("place", F.row_number().over(Window.orderBy(*by_name)) - 1)
    else:
        s = _before(s, by_name, {"place": F.lit(1)})
    s = s.withColumn("weight", F.get(F.lit(list(WEIGHTS)).cast("array<double>"), F.pmod(F.col("place"), F.lit(len(WEIGHTS))).cast("int"))).withColumn("most", F.col("source_size") * float(MOST)).drop("place")
    fills = [F.col("most") / F.col("weight"), *by_name]
    if few:
        earlier = Window.orderBy(*fills).rowsBetween(Window.unboundedPreceding, -1)
        s = s.withColumns({"full": F.coalesce(F.sum("most").over(earlier), F.lit(0.0)), "gone": F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))})
    else:
        s = _before(s, fills, {"full": F.col("most"), "gone": F.col("weight")})
    # the level of the first source that does not fill; those after it would give a lower one
    weights = sum(WEIGHTS) * (of["n"] // len(WEIGHTS)) + sum(WEIGHTS[: of["n"] % len(WEIGHTS)])
    level = (F.lit(float((of["words"] or 0) * SHARE)) - F.col("full")) / (F.lit(float(weights)) - F.col("gone"))
    s = materialize(s, "filled")
    level = s.agg(F.max(F.when(level <= F.col("most") / F.col("weight"), level))).first()[0]
    # all the sources fill up only if there are no words at all
    target = F.least(F.col("most"), F.lit(level) * F.col("weight")) if level is not None else F.col("most")
    return s.select("source", "source_size", "n_docs", target.alias("target"))


def _unit(ids: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in (0, 1) that depend on ids and salt alone."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((SEED * 1_000_003 + salt * 0x632BE59BD9B4E019) % (1 << 64))
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53) + 2.0**-54


def pivot(size: np.ndarray, p: np.ndarray, luck: np.ndarray) -> np.ndarray:
    """Round the fractions ``p`` of documents of ``size`` words, in order; at most one is left between 0 and 1.

    Sum of size * p stays the same and no fraction's expectation changes.
    """
    p = p.copy()
    open_at = -1
    for i in np.flatnonzero((p > 0) & (p < 1)):
        if open_at < 0:
            open_at = i
            continue
        a, b, wa, wb, pa, pb = open_at, i, size[open_at], size[i], p[open_at], p[i]
        up = min((1 - pa) * wa, pb * wb)  # words that may move from b to a
        down = min(pa * wa, (1 - pb) * wb)  # and from a to b
        if luck[i] * (up + down) < down:
            pa, pb, moved = pa + up / wa, pb - up / wb, up
            done_a, done_b = moved == (1 - p[a]) * wa, moved == p[b] * wb
            pa, pb = (1.0 if done_a else pa), (0.0 if done_b else pb)
        else:
            pa, pb, moved = pa - down / wa, pb + down / wb, down
            done_a, done_b = moved == p[a] * wa, moved == (1 - p[b]) * wb
            pa, pb = (0.0 if done_a else pa), (1.0 if done_b else pb)
        p[a], p[b] = min(max(pa, 0.0), 1.0), min(max(pb, 0.0), 1.0)
        open_at = a if 0 < p[a] < 1 else b if 0 < p[b] < 1 else -1
    return p


def pivot_pool(size: np.ndarray, p: float, luck: np.ndarray) -> np.ndarray:
    """Round the fraction ``p`` that all of some documents have, the largest document first.

    Each document is paired with the pool of all smaller ones, whose common
    fraction gives or takes the words: so it is the small documents that make
    up for what the large ones are off, and one of the smallest that is left.
    """
    out = np.full(len(size), p)
    if not 0 < p < 1:
        return out
    pool = np.cumsum(size[::-1])[::-1] - size
    for i in range(len(size)):
        w, rest = size[i], pool[i]
        up, down = min((1 - p) * w, p * rest), min(p * w, (1 - p) * rest)
        if up + down <= 0:  # nothing to pair with
            out[i] = p
            break
        if luck[i] * (up + down) < down:
            own, p, full, end = p + up / w, p - up / rest, up == (1 - p) * w, 0.0
        else:
            own, p, full, end = p - down / w, p + down / rest, down == p * w, 1.0
        if full:
            out[i] = 1.0 - end
            p = min(max(p, 0.0), 1.0)
        if not full or p in (0.0, 1.0):  # the pool became integral first
            out[i] = out[i] if full else min(max(own, 0.0), 1.0)
            out[i + 1 :] = p if full else end
            break
    return out


def _level(rows: DataFrame, level: int) -> DataFrame:
    """Round within each (source, bucket)."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "rank"], ascending=[False, True], kind="stable").reset_index(drop=True)
        luck = _unit(group["rank"].to_numpy(np.int64), level)
        size, p = group["size"].to_numpy(float), group["p"].to_numpy(float)
        some = size > 0
        if level == 0 and some.any():
            p[some] = pivot_pool(size[some], p[some][0], luck[some])
        return group.assign(p=pivot(size, p, luck))

    return rows.groupBy("source", "bucket").applyInPandas(run, rows.schema)


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows``, each with the number ``k`` of the repeat; repeats are counted, so a row that fills the table is no large group."""
    names = rows.columns
    counted = rows.groupBy(*names).agg(F.count("*").alias("n"))
    few = counted.where(F.col("n") <= RUN).withColumn("run", F.lit(0).cast("long"))
    many = counted.where(F.col("n") > RUN).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN)))).repartition(F.xxhash64(*names, "run"))
    last = F.least(F.col("n"), (F.col("run") + 1) * RUN)
    return few.unionByName(many).select(*names, F.explode(F.sequence(F.col("run") * RUN + 1, last)).alias("k"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size: Column | None = None, text_col: str = "text") -> DataFrame:
    """For each row of ``docs``: id, source, size, key (a hash of the text), source_size, target, copies.

    Empty documents take no part in the rounding and are taken by chance at
    the source's rate (they have no words to miss a target by). A null source
    is a source of its own. Reruns agree for any partitioning: chance depends
    on id, source, text, size and, of repeated rows, their number. Repeated
    rows are documents of their own; null ids are like any others.
    """
    size = size if size is not None else count_words(F.col(text_col))
    slim = materialize(docs.select(F.col(id_col).cast("string").alias("id"), F.col(source_col).alias("source"), size.cast("long").alias("size"), F.xxhash64(text_col).alias("key")), "sizes")
    targets = source_targets(slim)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(rate), F.lit(MOST)).cast("long")
    rows = _numbered(slim)
    rows = rows.join(targets, rows["source"].eqNullSafe(targets["source"]), "left").drop(targets["source"])
    rank = F.xxhash64("id", "source", "size", "key", "k", F.lit(SEED))
    rows = rows.select("id", "source", "size", "key", "source_size", "target", rank.alias("rank"), whole.alias("whole"), (rate - whole).alias("p"), "n_docs")
    bucket = F.pmod(F.xxhash64("rank"), F.ceil(F.col("n_docs") / BUCKET_ROWS).cast("long"))
    rows = rows.withColumn("bucket", bucket).drop("n_docs")
    chance = (F.pmod(F.xxhash64("rank", F.lit(1)), F.lit(1 << 30)) / (1 << 30)) < F.col("p")
    rows = rows.withColumn("p", F.when(F.col("size") == 0, chance.cast("double")).otherwise(F.col("p")))
    most = targets.agg(F.max("n_docs")).first()[0] or 0
    done, level = [], 0
    buckets = -(-most // BUCKET_ROWS)
    while True:
        rows = materialize(_level(rows, level), f"level{level}")
        if buckets <= 1:
            break
        done.append(rows.where("p = 0 OR p = 1"))
        rows = rows.where("p > 0 AND p < 1").withColumn("bucket", F.floor(F.col("bucket") / FAN_IN))
        buckets, level = -(-buckets // FAN_IN), level + 1
    last = F.when((F.col("p") > 0) & (F.col("p") < 1), (F.pmod(F.xxhash64("rank", F.lit(2)), F.lit(1 << 30)) / (1 << 30) < F.col("p")).cast("double")).otherwise(F.col("p"))
    out = rows.withColumn("p", last)
    for d in done:
        out = out.unionByName(d)
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias("id"), "source", "size", "key", "source_size", "target", (F.col("whole") + F.col("p").cast("long")).alias("copies"))


def repeat_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` as the mix takes them: each row as many times as it is taken, all columns kept.

    Copies are joined back by id, source and text, with the slim side hashed,
    so that no texts are sorted; what the mix takes of rows that agree in all
    of these is dealt out evenly among them, those that come first by a hash
    of all their columns getting what is left over. Only if there are such
    rows, rows are numbered.
    """
    copies = mix(docs, id_col, source_col, text_col=text_col).groupBy("id", "source", "key").agg(F.sum("copies").alias("all"), F.count("*").alias("n"))
    copies = materialize(copies, "copies")
    n_copies = copies.count()
    repeated = not copies.where("n > 1").isEmpty()
    tail = "_" * (1 + max(map(len, docs.columns)))
    copies = copies.select(*(F.col(c).alias(f"{c}{tail}") for c in copies.columns)).where(F.col(f"all{tail}") > 0)
    own, i, src, key, n, k, times = (F.col(f"{x}{tail}") for x in ("own", "id", "source", "key", "n", "k", "times"))
    rows = docs.withColumn(f"own{tail}", F.xxhash64(text_col))
    rows = rows.join(hashed(copies, n_copies), F.col(id_col).eqNullSafe(i) & (own == key) & F.col(source_col).eqNullSafe(src))
    number = F.row_number().over(Window.partitionBy(id_col, f"own{tail}", source_col).orderBy(F.xxhash64(*docs.columns)))
    rows = rows.withColumn(f"k{tail}", F.when(n > 1, number).otherwise(1) if repeated else F.lit(1))
    rows = rows.withColumn(f"times{tail}", F.floor((F.col(f"all{tail}") + n - k) / n).cast("int")).where(times > 0)
    return rows.withColumn(f"k{tail}", F.explode(F.array_repeat(F.lit(0), times))).select(*docs.columns)
