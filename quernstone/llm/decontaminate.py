"""Benchmark decontamination with one Aho-Corasick automaton over word numbers.

The windows of the benchmark items (13 words; a shorter item is one window)
are the patterns, each a sequence of numbers of words. A batch of texts is cut
into words once, the words are numbered, and the automaton reads them once;
hits are places of words, and these are places in bytes of the original.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize
from .words import FOLD, Words, chunks, frugal, one_model, string_parts, words_of

WINDOW = 13
#: Bytes of item texts in one automaton. Items beyond it go to further automata, each scanning the texts once.
ITEM_BYTES = 8 << 20
#: A document is contaminated if at least one in so many of its words is hit.
ONE_IN = 20
#: Bytes of texts that are scanned together, and the words of them that one lane of the scan reads.
_SCAN_BYTES, _LANE = 4 << 20, 128

_TABLE = bytes(int(x) or 32 for x in FOLD)
Items = tuple[tuple[str | None, str], ...]


def item_batches(items: DataFrame, id_col: str = "item_id", text_col: str = "text", most_bytes: int = ITEM_BYTES) -> Iterator[Items]:
    """The items as (id, text) tuples, in batches of at most ``most_bytes`` (a longer item is a batch of its own).

    Items with a null text have no windows; those with a null id count together as one item without an id.
    """
    rows = items.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).where("t IS NOT NULL")
    batch, size, some = [], 0, False
    for r in rows.toLocalIterator():
        n = len(r["t"].encode())
        if batch and size + n > most_bytes:
            yield tuple(batch)
            batch, size = [], 0
        batch.append((r["i"], r["t"]))
        size, some = size + n, True
    if batch or not some:
        yield tuple(batch)


class Automaton(NamedTuple):
    """Aho-Corasick over word numbers; node 0 is the root and nodes are numbered by depth, then parent, then word.

    So the edge to node k stands at place k - 1 of ``edges``, which is sorted:
    it takes 8 bytes, and a node 14 in all.
    """

    #: the words of the items; a word's number is its place from 1
    words: pa.Array
    #: parent * size + word of each node but the root; ends in a value above all
    edges: np.ndarray
    #: the root's child by word, 0 if it has none
    first: np.ndarray
    fail: np.ndarray
    #: words of the longest pattern that ends in a node, 0 if none does
    longest: np.ndarray
    #: nodes where a pattern ends, ascending, and the items of each
    ends: np.ndarray
    owners: np.ndarray
    ids: list[str | None]
    depth: int

    def step(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The states after one more word in each lane; word 0 is in no item."""
        out = self.first[word]
        lane = np.flatnonzero((state != 0) & (word != 0))
        s, w = state[lane].astype(np.int64), word[lane]
        while len(lane):
            key = s * len(self.first) + w
            at = np.searchsorted(self.edges, key)
            found = self.edges[at] == key
            out[lane[found]] = at[found] + 1
            s = self.fail[s[~found]].astype(np.int64)
            inner = s != 0
            lane, s, w = lane[~found][inner], s[inner], w[~found][inner]
        return out

    def items_at(self, node: int) -> set[str | None]:
        """The ids of all items with a pattern that ends in ``node``."""
        out: set[str | None] = set()
        while self.longest[node]:
            a, b = np.searchsorted(self.ends, [node, node + 1])
            out.update(self.ids[i] for i in self.owners[a:b])
            node = self.fail[node]
        return out


def automaton(items: Items, window: int) -> Automaton | None:
    return one_model((items, window), lambda: _automaton(items, window))


def _automaton(items: Items, window: int) -> Automaton | None:
    """The automaton over the windows of ``items``, built level by level; none if no item has a word."""
    numbers: dict[bytes, int] = {}
    words = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in text.encode("utf-8", "replace").translate(_TABLE).split()], np.int32) for _, text in items]
    sizes = np.array([len(x) for x in words])
    if not numbers:
        return None
    flat, size = np.concatenate(words), len(numbers) + 1
    windows = np.where(sizes > 0, np.maximum(sizes - window + 1, 1), 0)
    owner = np.repeat(np.arange(len(items), dtype=np.int32), windows)
    start = np.arange(len(owner)) + np.repeat(np.cumsum(sizes) - sizes - np.cumsum(windows) + windows, windows)
    length = np.minimum(sizes, window)[owner]
    node, levels, edges = np.zeros(len(owner), np.int64), [1], []
    for d in range(int(length.max())):
        live = slice(None) if d < length.min() else np.flatnonzero(length > d)
        edge, which = np.unique(node[live] * size + flat[start[live] + d], return_inverse=True)
        node[live] = levels[-1] + which
        edges.append(edge)
        levels.append(levels[-1] + len(edge))
    depth = len(edges)
    first = np.zeros(size, np.int32)
    first[edges[0]] = np.arange(1, levels[1])
    ending = np.unique(node * len(items) + owner)
    longest = np.zeros(levels[-1], np.uint16 if window < 1 << 16 else np.int32)
    longest[node] = length
    edges = np.concatenate([*edges, [np.iinfo(np.int64).max]])
    out = Automaton(pa.array(list(numbers), pa.large_binary()), edges, first, np.zeros(levels[-1], np.int32), longest, ending // len(items), (ending % len(items)).astype(np.int32), [i for i, _ in items], depth)
    for a, b in zip(levels[1:-1], levels[2:], strict=True):
        parent, word = np.divmod(edges[a - 1 : b - 1], size)
        out.fail[a:b] = out.step(out.fail[parent], word)
        longest[a:b] = np.maximum(longest[a:b], longest[out.fail[a:b]])
    return out


def _numbered(words: Words, machine: Automaton) -> np.ndarray:
    """The number of each word, 0 if no item has it."""
    at = np.concatenate([[0], np.cumsum(words.end - words.start)])
    body = np.ascontiguousarray(words.data[words.data != 0])
    own = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words.start), [None, pa.py_buffer(at), pa.py_buffer(body)])
    return pc.fill_null(pc.index_in(own, machine.words), -1).to_numpy().astype(np.int64) + 1


def _read(sequence: np.ndarray, machine: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``sequence`` where a pattern ends, ascending, and the states there.

    Lanes of the sequence are read together. As no pattern is longer than
    ``depth``, a lane that begins ``depth`` - 1 words early is in the right
    state at its own first word.
    """
    early, lanes = machine.depth - 1, -(-len(sequence) // _LANE)
    padded = np.zeros(early + lanes * _LANE, np.int64)
    padded[early : early + len(sequence)] = sequence
    columns = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, early + _LANE)[::_LANE].T)
    state, places, states = np.zeros(lanes, np.int32), [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for k, word in enumerate(columns):
        state = machine.step(state, word)
        if k >= early:
            hit = np.flatnonzero(machine.longest[state])
            places.append(hit * _LANE + (k - early))
            states.append(state[hit])
    places, states = np.concatenate(places), np.concatenate(states)
    order = np.argsort(places)
    return places[order], states[order]


def hits(column: pa.Array, machine: Automaton | None) -> Iterator[tuple[int, list[tuple[int, int]], set[str | None]]]:
    """For each text of ``column``: its number of words, its merged hit spans (first word, word after the last), its item ids."""
    for a, b, data, offsets in chunks(column, _SCAN_BYTES):
        words = words_of(data, offsets)
        counts = np.diff(words.first)
        if machine is None or not len(words.start):
            yield from ((int(n), [], set()) for n in counts)
            continue
        # a word that no item has stands between texts
        begin = words.first[:-1] + np.arange(b - a)
        sequence = np.zeros(len(words.start) + b - a, np.int64)
        sequence[np.arange(len(words.start)) + np.repeat(np.arange(b - a), counts)] = _numbered(words, machine)
        places, states = _read(sequence, machine)
        row = np.searchsorted(begin, places, "right") - 1
        last = places - begin[row] + 1
        found = {int(s): machine.items_at(s) for s in np.unique(states)}
        edge = np.searchsorted(row, np.arange(b - a + 1))
        for i, n in enumerate(counts):
            own = slice(edge[i], edge[i + 1])
            spans = _merge(list(zip((last[own] - machine.longest[states[own]]).tolist(), last[own].tolist(), strict=True)))
            yield int(n), spans, set().union(*(found[s] for s in set(states[own].tolist())))


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_SPAN = "array<struct<start: int, end: int>>"
_PAIRS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _pass_over(docs: DataFrame, text: str, items: DataFrame, window: int, item_bytes: int, finish: Callable[..., pa.RecordBatch], schema: T.StructType) -> DataFrame:
    """Stream ``docs`` past each automaton in turn; ``finish`` makes the last pass's batches.

    The driver reads the items one batch at a time and hands each on as a
    broadcast. Passes but the last are written as tables, so that a worker
    holds one automaton.
    ``finish`` gets the batch and, for each row, its word count, its merged hit spans and its item ids.
    """
    own = [f"{name}{'_' * (1 + max(map(len, docs.columns)))}" for name in ("spans", "ids")]
    t, n_columns = docs.columns.index(text), len(docs.columns)
    parts = [docs.sparkSession.sparkContext.broadcast(x) for x in item_batches(items, most_bytes=item_bytes)]
    out = docs.withColumns({own[0]: F.from_json(F.lit("[]"), _SPAN), own[1]: F.from_json(F.lit("[]"), "array<string>")}) if len(parts) > 1 else docs
    carried = out.schema
    for k, some in enumerate(parts):
        last = k == len(parts) - 1

        def run(batches: Iterator[pa.RecordBatch], some=some, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                machine = automaton(some.value, window)
                counts, spans, ids = [], [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
                if len(parts) > 1:
                    spans = [[(s["start"], s["end"]) for s in x] for x in batch.column(n_columns).to_pylist()]
                    ids = batch.column(n_columns + 1).to_pylist()
                for i, (n, found, items_hit) in enumerate(hits(batch.column(t), machine)):
                    counts.append(n)
                    if found:
                        spans[i] = _merge(spans[i] + found)
                        ids[i] = sorted(items_hit.union(ids[i]), key=lambda x: (x is None, x or ""))
                if last:
                    yield finish(batch, counts, spans, ids)
                else:
                    state = [_pairs(spans), pa.array(ids, pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays([*batch.columns[:n_columns], *state], batch.schema.names)

        out = out.mapInArrow(frugal(run), schema) if last else materialize(out.mapInArrow(frugal(run), carried), "pass")
    return out


def _pairs(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], _PAIRS)


def _bytes(column: pa.Array, spans: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
    """Word spans of each text as byte spans of the original; only texts with hits are looked at."""
    data, offsets = string_parts(column)
    out: list[list[tuple[int, int]]] = []
    for i, own in enumerate(spans):
        if own:
            at = words_of(data[offsets[i] : offsets[i + 1]], offsets[i : i + 2] - offsets[i])
            own = [(int(at.start[a]), int(at.end[b - 1])) for a, b in own]
        out.append(own)
    return out


def scan(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """For each row of ``docs``: id, n_words, hit word spans (merged), the same as byte spans of the original, item_ids (sorted, null last).

    A null or empty text has no words; repeated rows give repeated rows; an
    empty table on either side gives no rows or no hits; other columns are not
    read. No shuffle: texts stream past the automaton. Items of any size work:
    beyond ``item_bytes`` the texts pass several automata in turn.
    """
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("word_spans", span), T.StructField("byte_spans", span), T.StructField("item_ids", T.ArrayType(T.StringType()))])

    def finish(batch, counts, spans, ids):
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), _pairs(spans), _pairs(_bytes(batch.column(1), spans)), pa.array(ids, pa.list_(pa.string()))], schema.names)

    return _pass_over(docs.select(id_col, text_col), text_col, items, window, item_bytes, finish, schema)


def is_contaminated(n_hit: int, n_words: int) -> bool:
    return n_hit > 0 and ONE_IN * n_hit >= n_words


def digests(scanned: DataFrame) -> DataFrame:
    """Counts and the digest of the items of a scan; n_hit counts each word once, n_items counts a null id as one item, which the digest leaves out."""
    n_hit = F.aggregate("word_spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))
    ids = F.concat_ws(",", "item_ids")
    return scanned.select(
        scanned.columns[0],
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * ONE_IN >= F.col("n_words"))).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", window: int = WINDOW, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with all their columns; no shuffle.

    Rows without text have no words and stay; without items all rows stay; an
    empty table gives no rows; columns may have any names.
    """
    n = len(docs.columns)

    def finish(batch, counts, spans, ids):
        keep = [not is_contaminated(sum(b - a for a, b in s), words) for s, words in zip(spans, counts, strict=True)]
        return pa.RecordBatch.from_arrays(batch.columns[:n], batch.schema.names[:n]).filter(pa.array(keep, pa.bool_()))

    return _pass_over(docs, text_col, items, window, item_bytes, finish, docs.schema)
