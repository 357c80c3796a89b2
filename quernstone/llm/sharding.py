"""Sharding by minimax contiguous partition (DataFrame operations only).

Atomic groups (equal texts) stand in an order: groups that are no smaller than
a shard's fair share first, by size, then all others by a 64-bit key. The
smallest feasible shard capacity is found by binary search; a capacity is
feasible if cutting greedily, each shard as full as it goes, needs no more
shards than there are. A group of the first kind forces the capacity, so it
fills a shard alone and the capacity of the others is searched for anew behind
it. Within their capacity the cuts stand as near to equal shares as they can.

The driver never sees the groups. It holds the few of the first kind (fewer
than shards) and a histogram of key ranges of a bounded number of cells. Cells
bound each cut from both sides: as if a cell could not be cut at all, and as if
it could be cut anywhere. Only large cells and cells between the two bounds are
refined, until every cut falls between groups.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

SHARDS = 16
#: Cells of the first histogram, and about the most that one refinement asks for.
CELLS = 1 << 14
#: A cell of several groups above this part of a shard's fair share is refined first.
COARSE = 64
#: Key space: signed 64-bit integers, moved up by 2**63.
_SPACE, _SIGN = 1 << 64, 1 << 63
#: Rows for each numbering bucket, about.
BUCKET_ROWS = 50_000


class Cell(NamedTuple):
    """Keys whose upper bits, those above ``level``, are ``prefix``."""

    first: int
    level: int
    bytes: int
    groups: int


class Plan(NamedTuple):
    """``heavy``: keys of groups that have shards 0, 1, ... alone; ``cuts``: keys, moved up by 2**63, at which the shards behind the next one begin."""

    capacity: int
    heavy: list[int]
    cuts: list[int]


def text_key(text: Column) -> Column:
    """The order key of a text; equal texts share it (two different texts do so with probability 2**-64: they are then kept together)."""
    return F.xxhash64(text)


def _greedy(sums: list[int], capacity: int, shards: int) -> list[int] | None:
    """Cells before each cut, as full as ``capacity`` lets them be; None if there are too few shards."""
    cuts, at = [], 0
    for _ in range(shards):
        at = bisect_right(sums, sums[at] + capacity) - 1
        cuts.append(at)
        if at == len(sums) - 1:
            return cuts
    return None


def _smallest(feasible, low: int, high: int) -> int:
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if feasible(mid) else (mid + 1, high)
    return low


def capacity_of(sizes: list[int], shards: int) -> int:
    """The smallest capacity for ``sizes`` in order."""
    sums = [0, *accumulate(sizes)]
    return _smallest(lambda x: _greedy(sums, x, shards) is not None, max([0, *sizes]), sums[-1])


def even_cuts(sizes: list[int], capacity: int, shards: int) -> list[int]:
    """Sizes before each cut, near equal shares: no shard exceeds the (feasible) capacity, none is empty while there are sizes for all."""
    sums = [0, *accumulate(sizes)]
    n = len(sizes)
    if n <= shards:
        return list(range(1, n))
    least = [n] * (shards + 1)  # with fewer sizes before cut j, the shards behind it overflow
    for j in range(shards - 1, 0, -1):
        least[j] = bisect_left(sums, sums[least[j + 1]] - capacity)
    cuts, at = [], 0
    for j in range(1, shards):
        goal = sums[at] + (sums[-1] - sums[at]) / (shards - j + 1)
        near = bisect_left(sums, goal)
        near -= near > 0 and goal - sums[near - 1] < sums[min(near, n)] - goal
        at = max(least[j], at + 1, min(near, bisect_right(sums, sums[at] + capacity) - 1, n - (shards - j)))
        cuts.append(at)
    return cuts


def heavy_groups(largest: list[tuple[int, int]], total: int, shards: int) -> list[int]:
    """Of the largest groups (key, bytes), those that are no smaller than a fair share of what is left without the larger ones."""
    heavy = []
    for key, size in sorted(largest, key=lambda x: (-x[1], x[0])):
        if len(heavy) == shards - 1 or size * (shards - len(heavy)) < total:
            break
        heavy.append(key)
        total -= size
    return heavy


def plan_shards(groups: DataFrame, shards: int = SHARDS, cells: int = CELLS) -> Plan:
    """Where to cut. ``groups`` has a row (key, bytes) for each group, both not null; it is read a few times.

    No groups: no cuts.
    """
    found = groups.agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).first()
    if not found["n"]:
        return Plan(0, [], [])
    largest = [(r["key"], int(r["bytes"])) for r in groups.orderBy(F.desc("bytes"), "key").limit(shards).collect()]
    heavy = heavy_groups(largest, int(found["b"]), shards)
    top = [size for key, size in largest if key in heavy]
    rest, left, total = groups.where(~F.col("key").isin(heavy)) if heavy else groups, shards - len(heavy), int(found["b"]) - sum(top)
    state = [Cell(0, 64, total, found["n"] - len(heavy))] if found["n"] > len(heavy) else []
    while state:
        which = {i for i, x in enumerate(state) if x.groups > 1 and x.bytes * COARSE * left > total} or _doubtful(state, left)
        if not which:
            break
        state = _refine(rest, state, which, cells)
    sizes = [x.bytes for x in state]
    capacity = capacity_of(sizes, left)
    return Plan(max([capacity, *top]), heavy, [state[i].first for i in even_cuts(sizes, capacity, left)])


def _doubtful(state: list[Cell], shards: int) -> set[int]:
    """Cells of several groups in which a greedy cut may fall; none if the smallest capacity is known."""
    sums = [0, *accumulate(x.bytes for x in state)]
    high = _smallest(lambda x: _greedy(sums, x, shards) is not None, max(x.bytes for x in state), sums[-1])
    least = max([-(-sums[-1] // shards), *(x.bytes for x in state if x.groups <= 1)])
    low = _smallest(lambda x: _loose(sums, state, x, shards) is not None, least, high)
    if low == high:
        return set()
    early, late = _tight(sums, low, shards), _loose(sums, state, high, shards) or []
    late += [sums[-1]] * (shards - len(late))
    out = set()
    for a, b in zip(early, late, strict=True):
        out.update(range(bisect_right(sums, a) - 1, min(len(state) - 1, bisect_right(sums, b) - 1) + 1))
    return {i for i in out if state[i].groups > 1}


def _loose(sums: list[int], state: list[Cell], capacity: int, shards: int) -> list[int] | None:
    """Bytes before each cut if cells of several groups could be cut anywhere."""
    cuts, at = [], 0
    for _ in range(shards):
        at += capacity
        if at >= sums[-1]:
            return [*cuts, sums[-1]]
        i = bisect_right(sums, at) - 1
        if state[i].groups <= 1:
            at = max(sums[i], cuts[-1] if cuts else 0)
        cuts.append(at)
    return None


def _tight(sums: list[int], capacity: int, shards: int) -> list[int]:
    """Bytes before each cut if no cell could be cut; a cell that does not fit ends all."""
    cuts, at = [], 0
    for _ in range(shards):
        at = sums[bisect_right(sums, at + capacity) - 1]
        cuts.append(at)
    return cuts


def _signed(x: int) -> int:
    return (x + _SIGN) % _SPACE - _SIGN


def _refine(groups: DataFrame, state: list[Cell], which: set[int], cells: int) -> list[Cell]:
    """Split each of the cells ``which`` into as many key ranges of equal width as make about ``cells`` in all; empty ranges vanish.

    The cells go to the executors as small tables, one for each width, and are
    joined by prefix: the plan does not grow with their number.
    """
    bits = max(3, (cells // len(which)).bit_length() - 1)
    by_level = defaultdict(list)
    for i in which:
        by_level[state[i].level].append(state[i].first >> state[i].level)
    rows = groups.select(F.col("key").bitwiseXOR(F.lit(-_SIGN)).alias("place"), "bytes")
    child = F.lit(None)
    for level, prefixes in sorted(by_level.items()):
        finer = F.struct(F.lit(max(0, level - bits)).alias("level"), F.shiftrightunsigned("place", max(0, level - bits)).alias("prefix"))
        if level == 64:
            child = finer
            continue
        listed = groups.sparkSession.range(1).select(F.explode(F.split(F.lit(",".join(str(_signed(x)) for x in prefixes)), ",")).alias("p")).select(F.col("p").cast("long").alias(f"p{level}"))
        rows = rows.join(F.broadcast(listed), F.shiftrightunsigned("place", level) == F.col(f"p{level}"), "left")
        child = F.when(F.col(f"p{level}").isNotNull(), finer).otherwise(child)
    found = rows.select(child.alias("child"), "bytes").where("child IS NOT NULL").groupBy("child").agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).collect()
    fresh = [Cell((r["child"]["prefix"] % _SPACE) << r["child"]["level"], r["child"]["level"], int(r["b"]), int(r["n"])) for r in found]
    return sorted([x for i, x in enumerate(state) if i not in which] + fresh)


def add_shard(docs: DataFrame, key: Column, plan: Plan, name: str = "shard") -> DataFrame:
    """The shard of each row: no join, no shuffle. The key must not be null."""
    shard = F.lit(len(plan.heavy))
    for c in plan.cuts:
        shard = shard + F.when(key >= F.lit(c - _SIGN), 1).otherwise(0)
    for i, k in enumerate(plan.heavy):
        shard = F.when(key == F.lit(k), i).otherwise(shard)
    return docs.withColumn(name, shard.cast("int"))


def _fresh(docs: DataFrame, *names: str) -> list[str]:
    return [f"{x}_{'_' * max(map(len, docs.columns))}" for x in names]


def add_slots(docs: DataFrame, by: list[Column], shard_col: str = "shard", name: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without a gap, in parallel.

    Rows are numbered within buckets, by a hash of the values ``by`` (of any
    type, null is a value); the rows of the buckets before are added. If rows
    that agree in all of these overfill a bucket, the rows are written as a
    table and dealt by their place in its files instead.
    """
    docs = docs.drop(name)
    bucket, before, row, place = _fresh(docs, "bucket", "before", "row", "place")
    n = docs.count()
    of = n // BUCKET_ROWS + 1
    mixed = F.xxhash64(*by, F.lit(7))
    rows = docs.withColumn(place, mixed).withColumn(bucket, F.pmod(F.col(place), F.lit(of)))

    def counted(r: DataFrame) -> DataFrame:
        return materialize(r.groupBy(shard_col, bucket).agg(F.count("*").alias(before)), "buckets")

    counts = counted(rows)
    if (counts.agg(F.max(before)).first()[0] or 0) > 2 * BUCKET_ROWS:
        at = materialize(docs, "rows")
        at = at.select(*docs.columns, F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias(place))
        rows = at.withColumn(bucket, F.pmod(F.col(place), F.lit(of)))
        counts = counted(rows)
    sums = Window.partitionBy(shard_col).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(shard_col, bucket, F.coalesce(F.sum(before).over(sums), F.lit(0).cast("long")).alias(before))
    rows = rows.withColumn(row, F.row_number().over(Window.partitionBy(shard_col, bucket).orderBy(place)))
    return rows.join(F.broadcast(counts) if of * SHARDS < 1 << 17 else counts, [shard_col, bucket]).withColumn(name, F.col(before) + F.col(row) - 1).select(*docs.columns, name)


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str | None = "text", size: Column | None = None, key: Column | None = None, shards: int = SHARDS, cells: int = CELLS) -> DataFrame:
    """``docs`` with columns shard and slot: shard sizes near equal, equal texts together.

    ``size`` is the bytes of a row (UTF-8 bytes of the text plus 1; null text:
    1; a null size is 0), ``key`` its group's place in the order (null: 0).
    Null texts form one group. A text whose copies fill a fair share or more
    has a shard alone. With fewer groups than shards some shards stay empty.
    Ids may be of any type, null or repeated: repeated rows each have a slot.
    An empty table stays empty; columns that are named shard or slot already
    are replaced.
    """
    docs = docs.drop("shard", "slot")
    size = size if size is not None else F.coalesce(F.octet_length(text_col), F.lit(0)) + 1
    key = F.coalesce(key if key is not None else text_key(F.col(text_col)), F.lit(0).cast("long"))
    groups = materialize(docs.select(key.alias("key"), F.coalesce(size.cast("long"), F.lit(0).cast("long")).alias("bytes")).groupBy("key").agg(F.sum("bytes").alias("bytes")), "groups")
    return add_slots(add_shard(docs, key, plan_shards(groups, shards, cells)), [F.col(id_col), key])
