"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled
text. A text is parsed from left to right into phrases, each the longest string
that occurs in the language's sample (at least one character). A language costs
``phrases * log2(sample length)`` bits; the cheapest language wins.

Texts are parsed in blocks of ``BLOCK`` characters, which lets numpy advance
thousands of blocks of whole texts at once through one dense transition table.
Then each block is taken up again with the phrase in which the block before it
ended, up to the place where both parses meet, so the phrases are those of the
whole text; where they do not meet, as in periodic text, each content of a block
is parsed once for each state in which it is entered. Letters beyond the most frequent ones have their transitions in
sorted arrays, one a language.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .words import frugal, one_model, string_parts

BLOCK = 256
UNKNOWN = "und"
#: Bounds of the labelled sample, for each language: rows, characters taken from one row, characters in all.
ROWS_PER_LANG, CHARS_PER_ROW, CHARS_PER_LANG = 200, 2000, 24_000
#: Bound of the whole sample; with more than ten languages each gets an equal part of it.
CHARS_IN_ALL = 240_000
#: Letters with a column in the dense table; the other letters of the samples are looked up in sorted arrays.
LETTERS = 100
#: Languages learned at most, those with the most labelled texts: a bound of the sample, as each needs its part of it.
LANGS = 1000
#: Times that all blocks are taken up again together before the rest is settled in order.
ROUNDS = 4
_CHUNK_CHARS = 1 << 20


@dataclass(frozen=True)
class Samples:
    """Labelled text by language, in code-point order of the languages; bounded, so it may be broadcast."""

    langs: tuple[str, ...]
    texts: tuple[str, ...]


def held_out(doc_id):
    """Rows that no model may learn from: crc32 of the id as text leaves 1 modulo 3 (null id: not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def collect_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Samples:
    """A bounded sample of labelled rows, the same for any partitioning.

    Rows with a null id, text or language, letterless texts and held-out rows
    are not learned from. Rows are taken in the order of a hash of their ids; a row gives at
    most ``CHARS_PER_ROW`` characters, from a place that the hash picks.
    """
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    rows = rows.where("i IS NOT NULL AND l IS NOT NULL").where(~held_out(F.col("i"))).where(F.col("t").rlike(r"\p{L}")).withColumn("h", F.xxhash64("i"))
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l").limit(LANGS).collect()}
    if not counts:
        return Samples((), ())
    # four times the rows wanted are kept before any shuffle, so the sort below is over a bounded number of rows
    share = F.create_map(*(F.lit(x) for l, n in counts.items() for x in (l, min(1.0, 4 * ROWS_PER_LANG / n))))
    piece = F.greatest(F.lit(1), (F.pmod(F.shiftright("h", 20), F.greatest(F.length("t") - CHARS_PER_ROW, F.lit(1))) + 1).cast("int"))
    picked = (
        rows.where(F.pmod("h", F.lit(1 << 20)) < F.try_element_at(share, F.col("l")) * (1 << 20))
        .select("l", "h", "i", F.substring("t", piece, F.lit(CHARS_PER_ROW)).alias("t"))
        .withColumn("k", F.row_number().over(Window.partitionBy("l").orderBy("h", "i", "t")))
        .where(F.col("k") <= ROWS_PER_LANG)
    )
    texts: dict[str, str] = {}
    most = min(CHARS_PER_LANG, CHARS_IN_ALL // len(counts))
    for r in sorted(picked.collect(), key=lambda r: (r["l"], r["k"])):
        texts[r["l"]] = (texts.get(r["l"], "") + " " + r["t"])[:most]
    langs = tuple(sorted(l for l, t in texts.items() if any(map(str.isalpha, t))))
    return Samples(langs, tuple(texts[l] for l in langs))


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``codes``; state 0 is the root."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return step


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: whether it is a letter, and its lower-case form."""
    letter = np.frombuffer(bytes(chr(i).isalpha() for i in range(0x110000)), np.bool_)
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x3000):
        low = chr(i).lower()
        if len(low) == 1:
            lower[i] = ord(low)
    return letter, lower


def normalize(points: np.ndarray) -> np.ndarray:
    """Lower-case code points with every non-letter turned into a space."""
    letter, lower = _tables()
    return np.where(letter[points], lower[points], np.uint32(32))


class Parser:
    """Cross-parser of all languages: one table, advanced a character of all blocks at a time."""

    def __init__(self, samples: Samples):
        self.langs = samples.langs
        texts = [normalize(np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32)) for t in samples.texts]
        seen = Counter(int(x) for t in texts for x in t)
        seen.pop(32, None)
        seen = sorted(seen, key=lambda x: (-seen[x], x))
        common, rare = seen[:LETTERS], seen[LETTERS:]
        unseen = len(common) + 1
        self.code = np.full(0x110000, unseen, np.uint8)
        self.code[32] = 0
        self.code[common] = np.arange(1, unseen)
        self.n_rare = len(rare)
        self.rare = np.full(0x110000 if rare else 0, -1, np.int32)
        self.rare[rare] = np.arange(len(rare))
        width = unseen + 2  # a space, the common letters, unseen or rare, padding
        self.width, self.pad = width, width - 1
        parts, self.roots, self.rare_steps, at = [], [], [], 0
        for t in texts:
            codes = self.code[t].astype(np.int64)
            if rare:
                codes = np.where(self.rare[t] >= 0, self.rare[t] + width, codes)
            step = suffix_automaton(codes.tolist())
            to = np.zeros((len(step), width), np.int64)
            new = np.ones((len(step), width), np.int64)
            root = np.zeros(width, np.int64)
            first = [c for c in step[0] if c < width]
            root[first] = [step[0][c] for c in first]
            to[:] = root  # a phrase that can't go on ends; its next character begins another
            for s, out in enumerate(step):
                keys = [c for c in out if c < width]
                if s and keys:
                    to[s, keys] = [out[c] for c in keys]
                    new[s, keys] = 0
            to[:, self.pad], new[:, self.pad] = np.arange(len(step)), 0
            parts.append(((at + to) * width << 1 | new).astype(np.int32).ravel())
            self.roots.append(at * width)
            self.rare_steps.append(self._rare_steps(step, at))
            at += len(step)
        self.table = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.bits = np.array([math.log2(max(2, len(t))) for t in texts])

    def _rare_steps(self, step: list[dict[int, int]], at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys (state, rare letter), where they lead, and where a phrase that begins with a rare letter leads (-1: not in the sample)."""
        width = self.width
        keys = sorted(((at + s) * width * self.n_rare + c - width, (at + q) * width) for s, out in enumerate(step) if s for c, q in out.items() if c >= width)
        begin = np.full(self.n_rare, -1, np.int32)
        for c, q in step[0].items():
            if c >= width:
                begin[c - width] = (at + q) * width
        return np.array([k for k, _ in keys], np.int64), np.array([q for _, q in keys], np.int32), begin

    def phrases(self, points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        sizes = np.diff(offsets)
        blocks = -(-sizes // BLOCK)
        first = np.concatenate([[0], np.cumsum(blocks)])
        out = np.zeros((len(sizes), len(self.langs)), np.int64)
        if not first[-1] or not self.langs:
            return out
        grid = np.full(first[-1] * BLOCK, self.pad, np.uint8)
        place = np.arange(len(points)) + np.repeat(first[:-1] * BLOCK - offsets[:-1], sizes)
        points = normalize(points)
        grid[place] = self.code[points]
        grid = np.ascontiguousarray(grid.reshape(-1, BLOCK).T).astype(np.int32)
        letters = None
        if self.n_rare:
            letters = np.full(first[-1] * BLOCK, -1, np.int32)
            letters[place] = self.rare[points]
            letters = np.ascontiguousarray(letters.reshape(-1, BLOCK).T)
        some = blocks > 0
        goes_on = np.ones(first[-1], np.bool_)  # blocks that go on from the one before
        goes_on[first[:-1][some]] = False
        states, marks = np.empty(grid.shape, np.int32), np.empty(grid.shape, np.uint8)
        for k, root in enumerate(self.roots):
            state = np.full(grid.shape[1], root, np.int32)
            to = np.empty_like(state)
            for i, row in enumerate(grid):
                if letters is None:  # as in _advance, without new arrays
                    np.add(state, row, out=to)
                    to = self.table.take(to, out=to, mode="clip")
                    state = np.right_shift(to, 1, out=states[i])
                    np.bitwise_and(to, 1, out=marks[i], casting="unsafe")
                else:
                    states[i], marks[i] = state, _ = self._advance(k, state, row, letters[i])
            # every block began a phrase; now those that go on take over the state of the one before, until nothing changes
            counts, entry = marks.sum(0, dtype=np.int64), np.full(grid.shape[1], root, np.int32)
            todo = np.flatnonzero(goes_on)
            for _ in range(ROUNDS):
                state = states[-1, todo - 1]
                changed = state != entry[todo]
                at = todo = todo[changed]
                state = entry[todo] = state[changed]
                for i, row in enumerate(grid):
                    if not len(at):
                        break
                    state, mark = self._advance(k, state, row[at], None if letters is None else letters[i, at])
                    differ = state != states[i, at]
                    states[i, at], marks[i, at] = state, mark
                    at, state = at[differ], state[differ]
                counts[todo] = marks[:, todo].sum(0, dtype=np.int64)
                todo = at + 1
                todo = todo[todo < len(goes_on)]
                todo = todo[goes_on[todo]]
                if not len(todo):
                    break
            self._in_order(k, todo, grid, letters, states[-1], entry, counts, goes_on)
            out[some, k] = np.add.reduceat(counts, first[:-1][some])
        return out

    def _in_order(self, k: int, todo: np.ndarray, grid: np.ndarray, letters: np.ndarray | None, exits: np.ndarray, entry: np.ndarray, counts: np.ndarray, goes_on: np.ndarray) -> None:
        """Settle the blocks ``todo`` and those that follow from them one after the other.

        Parses of periodic text may never meet. There equal blocks are entered
        in equal states, so each (content, state) is parsed once; at worst each
        block is parsed once more.
        """
        known: dict[tuple, tuple[int, int]] = {}
        done = -1
        for b in todo.tolist():
            if b <= done:
                continue
            while b < len(goes_on) and goes_on[b] and exits[b - 1] != entry[b]:
                state = int(exits[b - 1])
                content = np.ascontiguousarray(grid[:, b]).tobytes(), None if letters is None else np.ascontiguousarray(letters[:, b]).tobytes()
                if (content, state) not in known:
                    known[content, state] = self._block(k, state, grid[:, b], None if letters is None else letters[:, b])
                entry[b] = state
                exits[b], counts[b] = known[content, state]
                done = b
                b += 1

    def _block(self, k: int, state: int, codes: np.ndarray, letters: np.ndarray | None) -> tuple[int, int]:
        """The state after a block, and the phrases that begin in it."""
        n, step = 0, self.table.item
        for i, c in enumerate(codes.tolist()):
            if letters is not None and letters[i] >= 0:
                after, mark = self._advance(k, np.array([state], np.int32), codes[i : i + 1], letters[i : i + 1])
                state, n = int(after[0]), n + int(mark[0])
            else:
                to = step(state + c)
                state, n = to >> 1, n + (to & 1)
        return state, n

    def _advance(self, k: int, state: np.ndarray, codes: np.ndarray, letters: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The states of language ``k`` after one more character, and whether a phrase began with it."""
        to = self.table[state + codes]
        after, mark = to >> 1, to & 1
        if letters is not None:
            keys, targets, begin = self.rare_steps[k]
            c = np.flatnonzero(letters >= 0)
            c = c[begin[letters[c]] >= 0]
            if len(c):  # the dense table took them for unseen: each a phrase of its own
                x = letters[c].astype(np.int64)
                after[c] = begin[x]
                if len(keys):
                    key = state[c].astype(np.int64) * self.n_rare + x
                    found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    on = keys[found] == key
                    after[c[on]] = targets[found[on]]
                    mark[c[on]] = 0
        return after, mark


def parser(samples: Samples) -> Parser:
    return one_model(samples, lambda: Parser(samples))


def predict(texts: pa.Array, samples: Samples) -> tuple[list[str], np.ndarray]:
    """Language and score of each text: ``und`` and 0 for null, for text without a letter and without samples.

    The score is the saving of the best language over the second best, as a
    share of the latter's bits (1 if there is one language). Ties go to the
    language that comes first in code-point order.
    """
    p = parser(samples)
    langs, scores = [], []
    column = texts.fill_null("").cast(pa.large_string())
    data, offsets = string_parts(column)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _CHUNK_CHARS, "right")) - 1)
        part = data[offsets[a] : offsets[b]]
        points = np.frombuffer(part.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
        begins = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
        at = begins[offsets[a : b + 1] - offsets[a]]
        if begins[-1] != len(points):  # bytes that are no UTF-8: each text by itself
            own = [part[x - offsets[a] : y - offsets[a]].tobytes().decode("utf-8", "replace") for x, y in zip(offsets[a:b], offsets[a + 1 : b + 1], strict=True)]
            points, at = np.frombuffer("".join(own).encode("utf-32-le"), np.uint32), np.cumsum([0, *map(len, own)])
        cost = p.phrases(points, at) * p.bits
        has = np.concatenate([[0], np.cumsum(_tables()[0][points])])
        has = has[at[1:]] > has[at[:-1]]
        for row, ok in zip(cost, has, strict=True):
            if not ok or not p.langs:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            best = int(np.argmin(row))
            rest = np.delete(row, best)
            langs.append(p.langs[best])
            scores.append(1.0 - row[best] / rest.min() if len(rest) else 1.0)
        a = b
    return langs, np.clip(np.array(scores, float), 0, 1)


def identify(docs: DataFrame, samples: Samples, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, lang_pred, score) for each row of ``docs``; only the text decides.

    Null, empty and letterless texts are ``und`` with score 0; repeated rows give
    repeated rows; an empty table gives none; other columns are not read.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = predict(batch.column(1), samples)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [id_col, "lang_pred", "score"])

    return docs.select(id_col, text_col).mapInArrow(frugal(run), schema)


def keep_identified(docs: DataFrame, samples: Samples, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language can be told, a null language filled in; all columns stay."""
    names = docs.columns
    t, l = names.index(text_col), names.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, _ = predict(batch.column(t), samples)
            columns = list(batch.columns)
            columns[l] = pa.array([x if x is not None else y for x, y in zip(columns[l].to_pylist(), langs, strict=True)], columns[l].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(pa.array([x != UNKNOWN for x in langs], pa.bool_()))

    return docs.mapInArrow(frugal(run), docs.schema)
