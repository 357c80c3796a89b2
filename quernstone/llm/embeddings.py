"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector passes it if its cap around the direction
holds the vector. The directions are structured: the space is turned at random
and cut into two halves, each half has ``DIRECTIONS`` random directions, and
every pair of them makes one filter, so that ``TABLES`` such product codes have
``TABLES * DIRECTIONS**2`` filters that nobody stores. A vector's filters are
list-decoded: all those that reach the score of its ``LISTED``-th best in each
code, found among the best halves alone.

1. Equal vectors of a label become one node with a count.
2. Nodes are joined on (label, filter). A bucket of up to ``BLOCK`` nodes is one
   cell; a larger one is cut into blocks, and each pair of blocks is a cell.
3. Before that, nodes of large buckets are tied to anchors: nodes within half
   the threshold's angle of the same anchor are linked for certain, so a dense
   group is counted as a whole and its pairs are never formed.
4. A cell multiplies its vectors and verifies every cosine in double precision.
   A pair counts in the first filter that its two nodes share, so the cells'
   counts add up; for the components a cell gives a spanning forest.

For a given dimension the number of directions is the greatest for which
simulated pairs at the threshold are missed by ``MISS`` at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, scratch
from .neardup import components
from .words import frugal

SIMILARITY = 0.93
TABLES, DIRECTIONS, LISTED = 4, 256, 6
#: Share of pairs at the threshold that may have no filter in common, and simulated pairs by which it is measured.
MISS, SIMULATED = 0.002, 2000
#: Nodes in a block of a bucket.
BLOCK = 512
#: Angles are rounded by far less.
MARGIN = 1e-7


class Codes:
    """Product codes of a dimension; the same on every machine."""

    def __init__(self, dim: int, directions: int):
        rng, self.halves = np.random.RandomState(dim), 2 if dim >= 8 else 1
        self.directions, self.turns, self.parts = directions, [], []
        for _ in range(TABLES):
            self.turns.append(np.linalg.qr(rng.normal(size=(dim, dim)))[0])
            widths = [dim // 2, dim - dim // 2] if self.halves == 2 else [dim]
            some = [rng.normal(size=(directions, w)) for w in widths]
            self.parts.append([x / np.linalg.norm(x, axis=1)[:, None] for x in some])

    def filters(self, unit: np.ndarray) -> np.ndarray:
        """The filters of each unit vector (rows), in order."""
        out, k = [], min(LISTED, self.directions)
        for t, (turn, parts) in enumerate(zip(self.turns, self.parts, strict=True)):
            x, at, best = unit @ turn, 0, []
            for c in parts:
                s = x[:, at : at + c.shape[1]] @ c.T
                at += c.shape[1]
                top = np.argpartition(-s, k - 1, axis=1)[:, :k]
                best.append((top, np.take_along_axis(s, top, 1)))
            if self.halves == 1:
                found = best[0][0]
            else:
                (a, sa), (b, sb) = best
                both = (sa[:, :, None] + sb[:, None, :]).reshape(len(unit), -1)
                top = np.argpartition(-both, k - 1, axis=1)[:, :k]
                found = np.take_along_axis((a[:, :, None] * self.directions + b[:, None, :]).reshape(len(unit), -1), top, 1)
            out.append(found.astype(np.int64) + t * self.directions**self.halves)
        return np.sort(np.concatenate(out, axis=1), axis=1)


def shared_filter(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of two lists of filters have one in common."""
    return (a[:, :, None] == b[:, None, :]).any((1, 2))


@lru_cache(maxsize=8)
def codes(dim: int, threshold: float) -> Codes:
    rng = np.random.RandomState(7)
    x, z = rng.normal(size=(2, SIMULATED, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z -= (z * x).sum(1)[:, None] * x
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * z / np.maximum(np.linalg.norm(z, axis=1), 1e-30)[:, None]
    directions = DIRECTIONS
    while True:
        found = Codes(dim, directions)
        if directions <= LISTED or 1 - shared_filter(found.filters(x), found.filters(y)).mean() <= MISS:
            return found
        directions //= 2


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows in double precision, of length one."""
    x = vectors.astype(float)
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _rows(lists: pa.Array) -> np.ndarray:
    """Lists of one length as a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def comparable(vector: Column, label: Column) -> Column:
    """Whether a row can have links: it has a label, and a vector that isn't empty or zero and has finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _coded(nodes: DataFrame, threshold: float) -> DataFrame:
    """(node, filters); filters of different dimensions differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            dims = lists.value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                some = pa.array(np.flatnonzero(dims == dim))
                found = codes(int(dim), threshold).filters(units(_rows(lists.take(some)))) + (int(dim) << 40)
                ends = pa.array(np.arange(len(some) + 1, dtype=np.int32) * found.shape[1])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(some), pa.ListArray.from_arrays(ends, pa.array(found.ravel()))], ["node", "filters"])

    return nodes.select("node", "vector").mapInArrow(frugal(run), "node long, filters array<long>")


def _near_anchors(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (node, anchor) that are within half the threshold's angle of each other."""
    least = math.cos(math.acos(max(-1.0, min(1.0, threshold))) / 2) + MARGIN
    x = nodes.select("node", F.col("vector").alias("x"))
    y = nodes.select(F.col("node").alias("anchor"), F.col("vector").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(ends):
                some = batch.take(pa.array(np.flatnonzero(ends == dim)))
                near = (units(_rows(some.column(2))) * units(_rows(some.column(3)))).sum(1) >= least
                yield pa.RecordBatch.from_arrays(some.columns[:2], ["node", "anchor"]).filter(pa.array(near))

    return pairs.join(x, "node").join(y, "anchor").select("node", "anchor", "x", "y").mapInArrow(frugal(run), "node long, anchor long")


def _forest(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """For each of n rows the first row of its component."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, left, label[right])
        np.minimum.at(label, right, label[left])
        label = label[label]
        if (label == before).all():
            return label


def links_of_cell(unit: np.ndarray, block: np.ndarray, group: np.ndarray, filters: np.ndarray, own: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of a cell that are linked and whose first common filter is ``own``; a cell of two blocks compares only across them."""
    near = np.triu(unit @ unit.T >= threshold, 1)
    if block[0] != block[-1]:
        near &= block[:, None] != block[None, :]
    i, j = np.nonzero(near)
    differ = group[i] != group[j]
    i, j = i[differ], j[differ]
    if len(i):
        rows = np.unique(np.concatenate([i, j]))
        less = np.unique(filters[rows][filters[rows] < own])
        if len(less):
            holds = np.zeros((len(unit), len(less) + 1), np.float32)
            at = np.searchsorted(less, filters[rows])
            at[filters[rows] >= own] = len(less)
            holds[rows[:, None], at] = 1
            first = ~((holds[:, :-1] @ holds[:, :-1].T)[i, j] > 0)
            i, j = i[first], j[first]
    return i, j


def _verified(cells: DataFrame, threshold: float) -> DataFrame:
    """(node, n, peer): links of a node to rows that a cell adds, counted with their copies, and a node of the same component."""
    names = ["label", "filter", "cell", "block", "node", "group", "copies", "filters", "vector"]

    def of(rows: pa.Table) -> pa.RecordBatch | None:
        column = {c: rows.column(c).combine_chunks() for c in names[1:]}
        number = {c: column[c].to_numpy() for c in ("filter", "block", "node", "group", "copies")}
        i, j = links_of_cell(units(_rows(column["vector"])), number["block"], number["group"], _rows(column["filters"]), int(number["filter"][0]), threshold)
        if not len(i):
            return None
        n = np.bincount(i, weights=number["copies"][j], minlength=rows.num_rows) + np.bincount(j, weights=number["copies"][i], minlength=rows.num_rows)
        some = np.flatnonzero(n)
        peers = number["node"][_forest(i, j, rows.num_rows)]
        return pa.RecordBatch.from_arrays([pa.array(number["node"][some]), pa.array(n[some].astype(np.int64)), pa.array(peers[some])], ["node", "n", "peer"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            keys = [held.column(c).combine_chunks() for c in names[:3]]
            label = keys[0].dictionary_encode().indices.to_numpy(zero_copy_only=False)
            new = np.zeros(held.num_rows, bool)
            for k in (label, keys[1].to_numpy(), keys[2].to_numpy()):
                new[1:] |= k[1:] != k[:-1]
            cuts = np.concatenate([[0], np.flatnonzero(new)])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b - a > 1 and (out := of(held.slice(a, b - a))) is not None:
                    yield out
            held = held.slice(cuts[-1])
        if held is not None and held.num_rows > 1 and (out := of(held)) is not None:
            yield out

    ordered = cells.select(*names).repartition("label", "filter", "cell").sortWithinPartitions("label", "filter", "cell", "block")
    return ordered.mapInArrow(frugal(run), "node long, n long, peer long")


def _cells(shared: DataFrame, block: int) -> DataFrame:
    """(label, filter, cell, block, node, group) of members (label, filter, node, group) of buckets.

    The largest group of a bucket of more than one block has blocks of its own,
    which are not compared with each other.
    """
    of_group = shared.groupBy("label", "filter", "group").agg(F.count("*").alias("n"))
    buckets = of_group.groupBy("label", "filter").agg(F.max(F.struct("n", "group")).alias("main"), F.sum("n").alias("all"))
    apart = (F.col("all") > block) & (F.col("main.n") > 1)
    main = F.when(apart, F.col("main.n")).otherwise(F.lit(0))
    buckets = buckets.where("main.n < all").select("label", "filter", F.when(apart, F.col("main.group")).alias("main"), F.ceil(main / block).cast("int").alias("a"), F.ceil((F.col("all") - main) / block).cast("int").alias("b"))
    place = F.xxhash64("node", F.lit(1))
    rows = shared.join(buckets, ["label", "filter"])
    inner = F.coalesce(F.col("group") == F.col("main"), F.lit(False))
    rows = rows.withColumn("block", F.when(inner, F.pmod(place, F.greatest("a", F.lit(1)))).otherwise(F.col("a") + F.pmod(place, F.col("b"))).cast("int"))
    others = F.when(inner, F.sequence(F.col("a"), F.col("a") + F.col("b") - 1)).otherwise(F.sequence(F.lit(0), F.col("a") + F.col("b") - 1))
    cell = F.transform(others, lambda o: F.shiftleft(F.least(o, F.col("block")).cast("long"), 31) + F.greatest(o, F.col("block")))
    return rows.select("label", "filter", F.explode(cell).alias("cell"), "block", "node", "group")


def _linked(nodes: DataFrame, threshold: float, block: int) -> DataFrame:
    """(node, n_links, component) of all nodes (node, label, vector, copies, least)."""
    coded = materialize(_coded(nodes, threshold), "coded")
    flat = nodes.select("node", "label").join(coded, "node").select("node", "label", F.explode("filters").alias("filter"))
    flat = materialize(flat, "flat")
    first = F.min(F.struct(F.xxhash64("node").alias("h"), "node"))
    sizes = materialize(flat.groupBy("label", "filter").agg(F.count("*").alias("n"), first.alias("anchor")).where("n > 1"), "sizes")
    shared = materialize(flat.join(sizes.select("label", "filter", "n", F.col("anchor.node").alias("anchor")), ["label", "filter"]), "shared")
    ties = materialize(_near_anchors(shared.where((F.col("n") > block) & (F.col("node") != F.col("anchor"))).select("node", "anchor").distinct(), nodes, threshold), "ties")
    groups = ties.groupBy("node").agg(F.min(F.struct(F.xxhash64("anchor").alias("h"), "anchor")).alias("best")).select("node", F.col("best.anchor").alias("group"))
    groups = materialize(nodes.select("node", "copies").join(groups, "node", "left").select("node", F.coalesce("group", "node").alias("group"), "copies"), "groups")
    shared = shared.join(groups, "node").select("label", "filter", "node", "group")
    carried = nodes.join(coded, "node").select("node", "copies", "filters", "vector")
    found = materialize(_verified(_cells(shared, block).join(carried, "node"), threshold), "found")

    whole = materialize(groups.groupBy("group").agg(F.sum("copies").alias("total"), F.min("node").alias("head")), "whole")
    grouped = groups.join(whole, "group").select("node", "total", "head")
    edges = found.where("node != peer").select(F.col("node").alias("u"), F.col("peer").alias("v")).unionByName(grouped.where("node != head").select(F.col("node").alias("u"), F.col("head").alias("v")))
    labels = components(materialize(edges, "links"))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    out = grouped.join(counts, "node", "left").join(labels, "node", "left").join(nodes.select("node", "least"), "node")
    out = materialize(out.select("node", "least", (F.coalesce("n", F.lit(0)) + F.col("total") - 1).alias("n_links"), F.coalesce("label", "node").alias("component")), "linked")
    least = out.groupBy("component").agg(F.min("least").alias("least"))
    return out.drop("least").join(least, "component").select("node", "n_links", "least")


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept) of each row: links to rows of the same label whose cosine is ``threshold`` or more.

    A row without a label, and a vector that is null, empty, zero or holds a
    null, NaN or infinite component, links with nothing: it is a component by
    itself. So do vectors of different lengths with each other. Repeated rows
    are vectors of their own and link with each other. component_id is the
    least id of the component; null ids are passed over, and a component of
    null ids only has a null one. kept says that id and component_id agree
    (nulls agree). An empty table gives no rows; other columns are not read.
    """
    kind = "array<float>" if rows.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    vector = F.col(vector_col).cast(kind)
    slim = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vector")).withColumn("ok", comparable(F.col("vector"), F.col("label")))
    able = slim.where("ok")
    with scratch(rows.sparkSession) as keep:
        nodes = able.groupBy("label", "vector").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
        nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
        linked = _linked(nodes, threshold, block).join(nodes.select("node", "label", "vector"), "node")
        linked = keep(materialize(linked.drop("node"), "by_vector"))
    out = slim.select("id", F.when(F.col("ok"), F.col("label")).alias("label"), F.when(F.col("ok"), F.col("vector")).alias("vector")).join(linked, ["label", "vector"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("least"))
    out = out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
