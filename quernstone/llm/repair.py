"""Structure repair of conversations: the cheapest edits that make roles alternate.

A repaired conversation is empty, or has an optional system turn and then pairs
of user and assistant turns. Each row is kept, given another role, or deleted;
turns may be inserted anywhere. Of all cheapest repairs the one counts whose
audit, the initials of its edits in order, comes first.

An insert run and the row after it make one *macro edit*, such as ``IIK``. The
macros are a prefix-free code in ASCII order, so audits of equally many rows
compare as their macros do, and no audit has to be carried along: the dynamic
programme over the four states of the grammar keeps, for each, the cost, the
*rank* of its audit among those of its layer, and a pointer to its parent with
the macro. Audits are read back along the pointers at the end.

Rows get places in order of their conversations. They are worked on in blocks
of ``BLOCK`` places: a block's result is the cheapest way from each state to
each other, with ranks, and such results are chained along a conversation, so a
conversation that holds a third of all rows is worked on by many tasks. Its
repaired text alone passes through a single one, as a stream: a SHA-256 has to
read it in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, scratch
from .words import frugal

#: Rows of a block; a power of two.
BLOCK = 1024
#: Costs of edits and of a truncated turn that stays: fixed values.
RETITLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Fates of damaged rows by crc32 modulo ``FATES``: fixed values.
FATES = 20
DROP, EMPTY, UNSTOP, TWICE, TO_USER = 0, 1, 2, 3, 4
#: White space and the ends of sentences: fixed values.
INK, STOPS = r"[^\x20\x09-\x0D]", ".!?"

#: States: nothing yet, after the system turn, after a user's, after an assistant's; inserting leads from one to another.
STATES, ACCEPTED = 4, (0, 3)
_INSERTED = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
MACROS = sorted(i + e for i in ("", "I", "II") for e in "DKR")
#: Kinds of rows: role initial s, u, a or another, then the fault: none, to be deleted, truncated.
INITIALS, FAULTS = "sua", 3
_FAR = 1 << 40
_PAIRS = {(0, 1), (1, 2), (2, 1)}


def _after_inserts(state: int, n: int) -> int:
    for _ in range(n):
        state = _INSERTED[state]
    return state


def _steps() -> tuple[np.ndarray, np.ndarray]:
    """For each kind of row and pair of states the cost of the best macro and its number."""
    cost = np.full((4 * FAULTS, STATES, STATES), _FAR, np.int64)
    code = np.zeros((4 * FAULTS, STATES, STATES), np.int64)
    for kind in range(4 * FAULTS):
        initial, fault = divmod(kind, FAULTS)
        for state in range(STATES):
            for m, macro in reversed(list(enumerate(MACROS))):
                at, price = _after_inserts(state, len(macro) - 1), INSERT * (len(macro) - 1)
                stays = price + (TRUNCATED if fault == 2 else 0)
                if macro[-1] == "D":
                    to, price = at, price + DELETE
                elif fault == 1:
                    continue
                elif macro[-1] == "R":
                    to, price = _INSERTED[at], stays + RETITLE
                elif (at == 0 and initial == 0) or (initial in (1, 2) and _INSERTED[at] == initial + 1):
                    to, price = initial + 1, stays
                else:
                    continue
                if price <= cost[kind, state, to]:  # of equals the first macro
                    cost[kind, state, to], code[kind, state, to] = price, m
    return cost, code


_COST, _CODE = _steps()


def _ranks(key: np.ndarray) -> np.ndarray:
    """Ranks of the last axis."""
    order = np.argsort(key, axis=-1, kind="stable")
    out = np.empty_like(order)
    np.put_along_axis(out, order, np.broadcast_to(np.arange(key.shape[-1]), key.shape), -1)
    return out


def solve(kinds: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Runs of rows, one after the other: cost and rank [run, from, to], and each run's edits [row, from, to].

    An edit is ``STATES * macro + state before``. All runs advance a row at a
    time together, the longest first.
    """
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    size, n = lengths[order], len(lengths)
    cost = np.full((n, STATES, STATES), _FAR, np.int64)
    cost[:, range(STATES), range(STATES)] = 0
    rank = np.zeros((n, STATES, STATES), np.int64)
    back: list[tuple[np.ndarray, np.ndarray]] = []
    for i in range(int(size[0]) if n else 0):
        live = int(np.searchsorted(-size, -i, "left"))
        kind = kinds[begin[:live] + i]
        c = cost[:live, :, :, None] + _COST[kind][:, None]  # [run, from, parent, to]
        tie = rank[:live, :, :, None] * len(MACROS) + _CODE[kind][:, None]
        parent = ((np.minimum(c, _FAR) << 12) + tie).argmin(2)
        cost[:live] = np.minimum(np.take_along_axis(c, parent[:, :, None], 2)[:, :, 0], _FAR)
        macro = _CODE[kind][np.arange(live)[:, None, None], parent, np.arange(STATES)]
        tie = np.take_along_axis(tie, parent[:, :, None], 2)[:, :, 0]
        rank[:live] = _ranks(np.where(cost[:live] < _FAR, tie, 1 << 30))
        back.append((parent.astype(np.int8), macro.astype(np.int8)))
    edits = np.zeros((int(lengths.sum()), STATES, STATES), np.int8)
    state = np.broadcast_to(np.arange(STATES), (n, STATES, STATES)).copy()
    for i in range(len(back) - 1, -1, -1):
        parent, macro = back[i]
        live = len(parent)
        here = state[:live]
        before = np.take_along_axis(parent, here, 2)
        edits[begin[:live] + i] = np.take_along_axis(macro, here, 2) * STATES + before
        state[:live] = before
    whole_cost, whole_rank = np.empty_like(cost), np.empty_like(rank)
    whole_cost[order], whole_rank[order] = cost, rank
    return whole_cost, whole_rank, np.split(edits, np.cumsum(lengths)[:-1]) if n else []


def chain(costs: list[list[int]], ranks: list[list[int]]) -> tuple[list[tuple[int, int]], int, int]:
    """The states (from, to) of each of a conversation's runs on the best way, the number of turns inserted at its end, and the cost."""
    cost, rank, back = [0] + [_FAR] * 3, [0] * 4, bytearray()
    for c, r in zip(costs, ranks, strict=True):
        best = [min((min(cost[q] + c[q * 4 + to], _FAR), rank[q], r[q * 4 + to], q) for q in range(4)) for to in range(4)]
        places = {k: i for i, k in enumerate(sorted({b[1:3] for b in best}))}
        cost, rank = [b[0] for b in best], [places[b[1:3]] for b in best]
        back.append(sum(b[3] << (2 * to) for to, b in enumerate(best)))
    ends = []
    for state in range(STATES):
        tail = next(k for k in range(3) if _after_inserts(state, k) in ACCEPTED)
        ends.append((cost[state] + INSERT * tail, rank[state], state, tail))
    total, _, state, tail = min(ends)
    way = []
    for x in reversed(back):
        before = x >> (2 * state) & 3
        way.append((before, state))
        state = before
    return way[::-1], tail, total


# ── rows ────────────────────────────────────────────────────────────────────


def _text(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) damaged by a checksum of ``conv_id:turn``: dropped, emptied, without stops, repeated, given to the user. Nulls but conv_id and turn are one space."""
    fate = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % FATES
    rows = rows.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), fate.alias("fate")).where(F.col("fate") != DROP)
    text = F.when(F.col("fate") == EMPTY, "").when(F.col("fate") == UNSTOP, F.regexp_replace("text", f"[{STOPS}]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == TO_USER, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fate") == TWICE, F.sequence(F.lit(0), F.lit(1))).otherwise(F.sequence(F.lit(0), F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with their place in order of (conv_id, turn, role, text), nulls first, over the whole table."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())


def _coded(placed: DataFrame) -> DataFrame:
    """(pos, conv_id, turn, fault, kind) of placed rows; fault is 0 none, 1 blank, 2 duplicate, 3 truncated."""
    ink = F.regexp_extract("text", f"(?s)({INK})[\\x20\\x09-\\x0D]*\\z", 1)
    slim = placed.select("pos", "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), (ink == "").alias("blank"), (~ink.isin(*STOPS)).alias("open"))
    # the first of rows that say the same is no duplicate: one aggregate, and a join on places, which are unique
    first = placed.groupBy("conv_id", "role", "text").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    slim = slim.join(first, "pos", "left")
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("open"), 3).otherwise(0)
    initial = F.when(F.col("initial") == "", 3).otherwise(F.coalesce(F.nullif(F.instr(F.lit(INITIALS), F.col("initial")), F.lit(0)) - 1, F.lit(3)))
    cost_class = F.when(fault.isin(1, 2), 1).when(fault == 3, 2).otherwise(0)
    return slim.select("pos", "conv_id", "turn", fault.alias("fault"), (initial * FAULTS + cost_class).cast("int").alias("kind"))


def _runs(coded: DataFrame, block: int) -> DataFrame:
    """A row for each run of a conversation in a block: first place, costs, ranks and edits of all ways through it, its ends and what is illegal in it."""
    n = STATES * STATES

    def of(rows: pa.Table) -> pa.RecordBatch:
        pos, conv, kind = (rows.column(c).combine_chunks() for c in ("pos", "conv_id", "kind"))
        places, kinds = pos.to_numpy(), kind.to_numpy()
        starts = np.flatnonzero(_new([conv.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False), places // block]))
        lengths = np.diff(np.append(starts, len(places)))
        cost, rank, edits = solve(kinds, lengths)
        initials = kinds // FAULTS
        legal = np.zeros((4, 4), bool)
        legal[tuple(zip(*_PAIRS, strict=True))] = True
        bad = np.zeros(len(kinds), np.int64)
        bad[1:] = ~legal[initials[:-1], initials[1:]]
        bad[starts] = 0
        size = lengths * n
        flat = np.concatenate([e.reshape(len(e), n).T.ravel() for e in edits])
        lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(starts) + 1, dtype=np.int32) * n), pa.array(x.ravel())) for x in (cost, rank)]
        ends = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
        ways = pa.ListArray.from_arrays(ends, pa.array(flat))
        last = np.append(starts[1:], len(places)) - 1
        return pa.RecordBatch.from_arrays(
            [conv.take(pa.array(starts)), pa.array(places[starts]), pa.array(lengths.astype(np.int32)), *lists, ways, *(pa.array(initials[x].astype(np.int8)) for x in (starts, last)), pa.array(np.add.reduceat(bad, starts))], names
        )

    names = ["conv_id", "first", "n", "cost", "rank", "ways", "begins", "ends", "illegal"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            places = held.column("pos").to_numpy() // block
            cut = int(np.searchsorted(places, places[-1]))  # the last block may go on
            if cut:
                yield of(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None:
            yield of(held)

    kind = coded.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, first long, n int, cost array<long>, rank array<long>, ways array<byte>, begins byte, ends byte, illegal long"
    rows = coded.select("pos", "conv_id", "kind").repartition(F.expr(f"pos div {block}")).sortWithinPartitions("pos")
    return rows.mapInArrow(frugal(run), schema)


def _new(keys: list[np.ndarray]) -> np.ndarray:
    out = np.ones(len(keys[0]), bool)
    out[1:] = False
    for k in keys:
        out[1:] |= k[1:] != k[:-1]
    return out


def _chained(runs: DataFrame) -> DataFrame:
    """(conv_id, first, way, tail, cost, illegal) of runs: the way (from * 4 + to) that the best repair takes; tail and the conversation's sums stand at its last run."""
    names = ["conv_id", "first", "way", "tail", "cost", "illegal"]

    def of(conv, firsts: list, costs: list, ranks: list, illegal: int) -> pa.RecordBatch:
        way, tail, cost = chain(costs, ranks)
        rest = [None] * (len(way) - 1)
        columns = [[conv] * len(way), firsts, [a * 4 + b for a, b in way], [0] * len(rest) + [tail], [*rest, cost], [*rest, illegal]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    kind = runs.schema["conv_id"].dataType
    types: list[pa.DataType] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, firsts, costs, ranks, illegal, ends = None, [], [], [], 0, -1
        out: list[pa.RecordBatch] = []
        for batch in batches:
            types[:] = [batch.schema.field(0).type, pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            for c, first, cost, rank, begins, last, bad in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if firsts and c != conv:
                    out.append(of(conv, firsts, costs, ranks, illegal))
                    firsts, costs, ranks, illegal = [], [], [], 0
                illegal += bad + (1 if firsts and (ends, begins) not in _PAIRS else 0)
                conv, ends = c, last
                firsts.append(first)
                costs.append(cost)
                ranks.append(rank)
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                out = []
        if firsts:
            yield of(conv, firsts, costs, ranks, illegal)

    schema = f"conv_id {kind.simpleString()}, first long, way int, tail int, cost long, illegal long"
    rows = runs.select("conv_id", "first", "cost", "rank", "begins", "ends", "illegal").repartition("conv_id").sortWithinPartitions("conv_id", "first")
    return rows.mapInArrow(frugal(run), schema)


def _spelled(edit: Column, tail: Column, role: Column, text: Column) -> tuple[Column, Column]:
    """An edit's part of the audit, and its lines, each after a line feed."""
    names = [(MACROS[e // STATES], e % STATES) for e in range(len(MACROS) * STATES)]

    def inserted(state: int, n: int) -> str:
        return "".join(f"\n{_ROLE[_after_inserts(state, k + 1)]}:" for k in range(n))

    def turn(macro: str, state: int) -> str:
        return _ROLE[_INSERTED[_after_inserts(state, len(macro) - 1)]] if macro[-1] == "R" else ""

    def pick(values: list[str]) -> Column:
        return F.element_at(F.lit(values), edit + 1)

    what = pick([m[-1] for m, _ in names])
    own = F.when(what == "D", "").otherwise(F.concat(F.lit("\n"), F.when(what == "K", role).otherwise(pick([turn(m, s) for m, s in names])), F.lit(":"), text))
    # a tail is only ever one turn after a user's, or two after a system's turn
    more = F.when(tail == 1, "\nassistant:").when(tail == 2, "\nuser:\nassistant:").otherwise("")
    audit = F.concat(pick([m for m, _ in names]), F.repeat(F.lit("I"), tail))
    return audit, F.concat(pick([inserted(s, len(m) - 1) for m, s in names]), own, more)


def _digested(lines: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256) of rows (conv_id, pos, audit, lines), each conversation read as a stream."""
    names = ["conv_id", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, digest, began, some, kind = None, [], hashlib.sha256(), False, False, None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (kind, pa.string(), pa.string()), strict=True)], names)

        for batch in batches:
            done, kind = [], batch.schema.field(0).type
            for c, piece, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).cast(pa.binary()).to_pylist(), strict=True):
                if some and c != conv:
                    done.append((conv, "".join(audit), digest.hexdigest()))
                    audit, digest, began = [], hashlib.sha256(), False
                conv, some = c, True
                audit.append(piece)
                if text:
                    digest.update(text if began else text[1:])
                    began = True
            if done:
                yield out(done)
        if some:
            yield out([(conv, "".join(audit), digest.hexdigest())])

    schema = f"conv_id {lines.schema['conv_id'].dataType.simpleString()}, audit string, repaired_sha256 string"
    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(frugal(run), schema)


def repaired_rows(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with conv_id, pos, audit, lines), (what each conversation costs), (rows by fault), written as tables."""
    placed = materialize(_placed(rows), "placed")
    coded = materialize(_coded(placed), "coded")
    runs = materialize(_runs(coded, block), "runs")
    chained = materialize(_chained(runs), "chained")
    # of a block's runs the edits on their conversations' best ways, one after the other
    n = F.col("n")
    way = F.slice("ways", F.col("way") * n + 1, n)
    ends = F.transform(F.sequence(F.lit(1), n), lambda i: F.when(i == n, F.col("tail")).otherwise(F.lit(0)).cast("byte"))
    taken = runs.select("first", "n", "ways").join(chained.select("first", "way", "tail"), "first").select("first", way.alias("edits"), ends.alias("tails"))
    blocks = taken.groupBy(F.expr(f"first div {block}").alias("block")).agg(F.min("first").alias("base"), F.sort_array(F.collect_list(F.struct("first", "edits", "tails"))).alias("runs"))
    blocks = blocks.select("block", "base", F.flatten(F.transform("runs", lambda r: r["edits"])).alias("edits"), F.flatten(F.transform("runs", lambda r: r["tails"])).alias("tails"))
    at = (F.col("pos") - F.col("base") + 1).cast("int")
    joined = placed.withColumn("block", F.expr(f"pos div {block}")).join(blocks, "block")
    joined = joined.select("conv_id", "pos", "role", "text", F.element_at("edits", at).cast("int").alias("edit"), F.element_at("tails", at).cast("int").alias("tail"))
    audit, lines = _spelled(F.col("edit"), F.col("tail"), F.col("role"), F.col("text"))
    return joined.select("conv_id", "pos", audit.alias("audit"), lines.alias("lines")), chained.where("cost IS NOT NULL"), coded


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for each conversation of ``rows`` (conv_id, turn, role, text).

    Rows are in order of (turn, role, text), nulls first; repeated rows stand
    side by side. Null roles and texts are one space, so such a role is neither
    system, user nor assistant, and such a text is blank. A null conv_id is a
    conversation. gaps leaves null turns out. An empty table gives no rows;
    other columns are not read; a conversation or text may be of any length.
    """
    rows = rows.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"))
    with scratch(rows.sparkSession) as keep:
        lines, costs, coded = repaired_rows(rows, block)
        texts = materialize(_digested(lines), "texts")
        faults = coded.groupBy("conv_id").agg(*(F.count_if(F.col("fault") == i).alias(c) for i, c in ((1, "blank"), (2, "duplicate"), (3, "truncated"))))
        turns = coded.groupBy("conv_id").agg(F.max("turn").alias("b"), F.min("turn").alias("a"), F.count_distinct("turn").alias("d"))
        turns = turns.select("conv_id", F.coalesce(F.col("b") - F.col("a") + 1 - F.col("d"), F.lit(0)).cast("long").alias("gaps"))
        parts = [p.select(F.col("conv_id").alias(f"c{i}"), *(c for c in p.columns if c != "conv_id")) for i, p in enumerate((faults, turns, costs.select("conv_id", "cost", "illegal")))]
        for i, p in enumerate(parts):
            texts = texts.join(p, F.col("conv_id").eqNullSafe(F.col(f"c{i}"))).drop(f"c{i}")
        return keep(materialize(texts.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"), "repaired"))


def with_all(repaired: DataFrame, rows: DataFrame) -> DataFrame:
    """``repaired`` with conversations of ``rows`` that have none left: zeros, an empty audit, and the digest of nothing."""
    ids = rows.select(F.col("conv_id").alias("own")).distinct()
    out = ids.join(repaired, F.col("own").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("own").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
