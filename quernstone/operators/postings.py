"""The search index as stored tables: entries, and posting lists by which a search finds its candidates.

A posting list holds the entries of a token. Tokens are a title's letters, the
letters of all fields, their pairs of neighbouring letters, and the whole
title. An entry whose field contains a query has all of the query's pairs; one
whose title merely shares letters with it has them among its title's letters.
So the lists of a query's tokens give all entries whose score can be above
zero, and only these are scored.

Both tables are cut into folders, postings by a checksum of the token and
entries by their chunk of numbers, so that a search reads the folders of its tokens and
of its candidates. Building writes a new version; a manifest makes it current.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import Manifests, delete
from . import index as ix

#: Folders of the postings and of the entries; entries of a posting row at most.
FOLDERS, CHUNK = 64, 4096
#: A title that shares so much of a query's letters may be meant: a fixed value of the score.
OVERLAP = 0.6
TITLE_LETTER, LETTER, PAIR, TITLE = "t", "a", "b", "x"
POSTING = "token string, category_dir string, chunk long, entries array<long>"


def folder_of(token: str) -> int:
    return zlib.crc32(token.encode()) % FOLDERS


def _part(entry: Column) -> Column:
    """The folder of an entry: neighbours share it, so a task that writes a few chunks writes a few files and not one in every folder."""
    return F.pmod(F.hash(F.shiftright(entry, CHUNK.bit_length() - 1)), F.lit(FOLDERS)).cast("int")


#: What stands for the second letter of a token of one letter: no code point is so large. Bits of a code point and of a row's number.
_LETTER, _TITLE_LETTER, _BITS = 0x1FFFFF, 0x1FFFFE, 21


def _letters(texts: list[str], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of all texts, the row that each belongs to, and whether the next one is in the same text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
    text = np.repeat(np.arange(len(texts)), lengths)
    return points, rows[text], text[:-1] == text[1:]


def _lists(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """The posting rows of a chunk's entries of one directory; each (token, entry) is one number, and they are sorted once."""
    group = group.sort_by("entry")
    entries, titles, previews, categories = (group[c].combine_chunks() for c in ("entry", "title", "preview", "categories"))
    numbers, rows = entries.to_numpy(zero_copy_only=False), np.arange(len(group))
    named, owners = categories.flatten().to_pylist(), np.repeat(rows, categories.value_lengths().to_numpy(zero_copy_only=False))
    title_texts = titles.to_pylist()
    points, row, joined = _letters(title_texts + previews.to_pylist() + named, np.concatenate([rows, rows, owners]))
    own, own_row, _ = _letters(title_texts, rows)
    found = [(own, np.full(len(own), _TITLE_LETTER), own_row), (points, np.full(len(points), _LETTER), row), (points[:-1][joined], points[1:][joined], row[:-1][joined])]
    found = np.unique(np.concatenate([((a << _BITS | b) << _BITS) | r for a, b, r in found]))
    tokens, places = found >> _BITS, found & ((1 << _BITS) - 1)
    starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else tokens
    written = []
    for first, second in zip((tokens[starts] >> _BITS).tolist(), (tokens[starts] & ((1 << _BITS) - 1)).tolist(), strict=True):
        written.append(TITLE_LETTER + chr(first) if second == _TITLE_LETTER else LETTER + chr(first) if second == _LETTER else PAIR + chr(first) + chr(second))
    order = np.array(sorted(rows, key=title_texts.__getitem__), np.int64)
    ahead = [i for i, r in enumerate(order) if i == 0 or title_texts[r] != title_texts[order[i - 1]]]
    written += [TITLE + title_texts[order[i]] for i in ahead]
    offsets = np.concatenate([starts, len(found) + np.array(ahead, np.int64), [len(found) + len(order)]]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers[np.concatenate([places, order])], pa.int64()))
    return pa.table({"token": pa.array(written, pa.string()), "category_dir": pa.array([key[0].as_py()] * len(written), pa.string()), "chunk": pa.array([key[1].as_py()] * len(written), pa.int64()), "entries": lists})


def postings_of(entries: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(token, category_dir, chunk, entries): lists in rows of bounded length, so a token of half the entries is no large group.

    Entries are grouped, not their tokens: a group has ``chunk`` entries at most, and only its finished lists leave it.
    """
    if not 0 < chunk <= 1 << 20:
        raise ValueError(f"a chunk has 1 to {1 << 20} entries, not {chunk}")
    title, preview = (F.lower(F.coalesce(c, F.lit(""))).alias(c) for c in ("title", "preview"))
    named = F.filter(F.transform(F.coalesce("categories", F.array().cast("array<string>")), F.lower), F.isnotnull).alias("categories")
    rows = entries.select("category_dir", F.expr(f"entry div {chunk}").alias("chunk"), "entry", title, preview, named)
    rows = rows.groupBy("category_dir", "chunk").applyInArrow(_lists, POSTING)
    return rows.withColumn("folder", (F.crc32(F.col("token").cast("binary")) % FOLDERS).cast("int"))


def build(entries: DataFrame, path: str) -> int:
    """Write a new version of the index of ``entries`` (as :func:`index.build_index` gives them) and make it current; its number."""
    spark = entries.sparkSession
    manifests = Manifests(spark, path)
    version = max(manifests.versions(), default=-1) + 1
    root = f"{path.rstrip('/')}/data-{version}-{uuid.uuid4().hex[:8]}"
    numbered = entries.withColumn("entry", F.monotonically_increasing_id())
    numbered.withColumn("part", _part(F.col("entry"))).write.partitionBy("part").parquet(f"{root}/entries")
    stored = spark.read.schema(numbered.schema).parquet(f"{root}/entries")
    postings_of(stored).hint("rebalance", "folder").sortWithinPartitions("folder", "token").write.partitionBy("folder").parquet(f"{root}/postings")
    manifests.publish(version, {"data": root.rsplit("/", 1)[1], "entries": numbered.schema.jsonValue()})
    return version


class StoredIndex:
    """A stored index; it answers from the version that was current when it was opened or last reloaded."""

    def __init__(self, spark: SparkSession, path: str):
        self.sparkSession, self.path = spark, path.rstrip("/")
        self.reload()

    def reload(self) -> StoredIndex:
        """Take up the current version."""
        from pyspark.sql.types import StructType

        found = Manifests(self.sparkSession, self.path).read()
        if found is None:
            raise FileNotFoundError(self.path)
        self.root, self.schema = f"{self.path}/{found['data']}", StructType.fromJson(found["entries"])
        return self

    def _table(self, name: str, schema: str) -> DataFrame:
        return self.sparkSession.read.schema(schema).parquet(f"{self.root}/{name}")

    def entries(self) -> DataFrame:
        return self._table("entries", self.schema).drop("entry")

    def postings(self, tokens: list[str], bucket: str = "") -> DataFrame:
        """The posting rows of some tokens: a scan of their folders alone."""
        rows = self._table("postings", f"{POSTING}, folder int")
        rows = rows.where(F.col("folder").isin(sorted({folder_of(t) for t in tokens})) & F.col("token").isin(tokens))
        return rows.where(F.col("category_dir") == bucket) if bucket else rows

    def candidates(self, query: str, bucket: str = "") -> DataFrame:
        """(entry) of all entries whose score for a query can be above zero."""
        q = query.lower().strip()
        inside = {PAIR + q[i : i + 2] for i in range(len(q) - 1)} or {LETTER + q}
        letters = {TITLE_LETTER + c: n for c, n in Counter(q).items()} if len(q) >= 2 else {}
        weight = F.create_map(*(F.lit(x) for t in sorted(inside | letters.keys()) for x in (t, letters.get(t, 0))))
        rows = self.postings(sorted(inside | letters.keys()), bucket)
        rows = rows.select(F.col("token").isin(sorted(inside)).cast("int").alias("one"), weight[F.col("token")].alias("letters"), F.explode("entries").alias("entry"))
        found = rows.groupBy("entry").agg(F.sum("one").alias("inside"), F.sum("letters").alias("letters"))
        able = F.col("inside") == len(inside)
        return found.where(able | (F.col("letters") >= len(q) * OVERLAP) if letters else able).select("entry")

    def _entries_of(self, candidates: DataFrame) -> DataFrame:
        """The entries of candidates: the driver learns which folders they are in, at most ``FOLDERS``, so that no other is read."""
        parts = [r["part"] for r in candidates.select(_part(F.col("entry")).alias("part")).distinct().collect()]
        from pyspark.sql.types import IntegerType, StructType

        schema = StructType(list(self.schema.fields)).add("part", IntegerType())
        rows = self._table("entries", schema).where(F.col("part").isin(sorted(parts)) if parts else F.lit(False))
        return rows.join(candidates, "entry", "left_semi").drop("entry", "part")

    def search(self, query: str, bucket: str = "", limit: int = 5) -> DataFrame:
        """As :func:`index.search` over all entries."""
        if not query.strip():
            return ix.search(self.entries(), query, bucket, limit)
        return ix.search(self._entries_of(self.candidates(query, bucket)), query, bucket, limit)

    def get_by_title(self, title: str, bucket: str = "") -> DataFrame:
        found = self.postings([TITLE + title.lower().strip()], bucket).select(F.explode("entries").alias("entry"))
        return ix.get_by_title(self._entries_of(found), title, bucket)


def remove_old(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete the data of all versions but the last ones."""
    manifests = Manifests(spark, path)
    for v in manifests.versions()[:-keep]:
        delete(spark, f"{path.rstrip('/')}/{manifests.read(v)['data']}")
        delete(spark, f"{manifests.path}/{v:010d}.json")
