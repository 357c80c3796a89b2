"""URL filters: a blocked Bloom filter in front of an exact hash join (DataFrame operations only).

A rule is a host, which stands for its subdomains too, and the beginning of a
path. A URL is looked up under every (parent host, path beginning) that some
rule could have; the Bloom filter lets few of those pass that no rule has, the
join with the rules removes these, and the longest rule left decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

#: A block is WORDS_IN_BLOCK longs; a key sets one bit in each.
WORDS_IN_BLOCK = 4
#: Blocks at most, whatever the number of rules: 5 MB, so that the filter may be broadcast. More rules make
#: it pass more, never less; the join stays exact.
MOST_BLOCKS = 1 << 17
RULES_PER_BLOCK = 16
#: Bytes of hosts and paths up to which the rules go to all tasks; more are joined by a shuffle, in which a rule's URLs
#: are dealt out to some parts, as ``net`` may stand above a third of all URLs.
BROADCAST_BYTES, PARTS = 8 << 20, 16
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\n"), path)


def _block(hashed: Column, blocks: int) -> Column:
    return F.pmod(hashed, F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    bits = F.xxhash64(key, F.lit(7))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")) for i in range(WORDS_IN_BLOCK)]


def bloom_filter(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """The blocks (block, w0, w1, ...) of a blocked Bloom filter of ``keys``: at most ``blocks`` rows."""
    masks = {f"w{i}": m for i, m in enumerate(_masks(F.col(column)))}
    rows = keys.select(_block(F.xxhash64(column), blocks).alias("block"), *(m.alias(n) for n, m in masks.items()))
    return rows.groupBy("block").agg(*(F.bit_or(n).alias(n) for n in masks))


def _may_hold(key: Column) -> Column:
    out = F.lit(True)
    for i, m in enumerate(_masks(key)):
        out = out & (F.col(f"w{i}").bitwiseAND(m) != 0)
    return out


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """``pages`` with columns host, path, rule and verdict.

    ``rules`` has (host, path, verdict) in canonical form (lower-case host).
    The longest matching rule (host and path together, then the host, then
    code-point order) gives the verdict; without one it is ``default``. A null
    URL or one without ``://`` has an empty host and path and no rule. Columns
    of ``pages`` with these four names are replaced. Repeated rows stay.
    """
    pages = pages.drop("host", "path", "rule", "verdict")
    listed = rules.where("host IS NOT NULL AND path IS NOT NULL").select(_key(F.col("host"), F.col("path")).alias("key"), F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    # repeated rules: the strictest verdict ("block" after "allow" in code-point order)
    listed = listed.groupBy("key", "rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict"))
    seen = listed.agg(F.count("*").alias("n"), F.sum(F.octet_length("key")).alias("bytes"), F.collect_set(F.length("rule_path")).alias("lengths")).first()
    blocks = max(1, min(MOST_BLOCKS, seen["n"] // RULES_PER_BLOCK))
    bloom = bloom_filter(listed, "key", blocks)

    # a URL is judged once, however often it stands in the table
    urls = pages.select(F.col(url_col).alias("url")).where(F.instr(F.col("url"), "://") > 0).distinct()
    urls = urls.select("url", host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p"))
    labels = F.split("h", r"\.", -1)
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    urls = urls.withColumn("parents", parents).withColumn("starts", F.filter(F.lit(sorted(seen["lengths"])).cast("array<int>"), lambda n: n <= F.length("p")))
    keys = F.flatten(F.transform("parents", lambda h: F.transform("starts", lambda n: _key(h, F.substring(F.col("p"), F.lit(1), n)))))
    tries = urls.select("url", F.explode(keys).alias("key")).withColumn("block", _block(F.xxhash64("key"), blocks))
    possible = tries.join(F.broadcast(bloom), "block").where(_may_hold(F.col("key"))).select("url", "key")
    if (seen["bytes"] or 0) <= BROADCAST_BYTES:
        exact = possible.join(F.broadcast(listed), "key")
    else:
        dealt = listed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        exact = possible.withColumn("part", F.pmod(F.xxhash64("url"), F.lit(PARTS)).cast("int")).join(dealt, ["key", "part"])
    size = F.length("rule_host") + F.length("rule_path")
    best = exact.groupBy("url").agg(F.max(F.struct(size, F.length("rule_host"), "rule_host", "rule_path", "rule_verdict")).alias("best"))
    best = best.select(F.col("url").alias("judged_url"), F.concat("best.rule_host", "best.rule_path").alias("rule"), F.col("best.rule_verdict").alias("verdict"))
    out = pages.withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col)))
    # rows without a host take no part in the join: their nulls would all meet in one task
    has = F.coalesce(F.instr(F.col(url_col), "://") > 0, F.lit(False))
    judged = out.where(has).join(best, F.col(url_col) == F.col("judged_url"), "left").drop("judged_url")
    others = out.where(~has).withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")})
    return judged.unionByName(others).withColumn("verdict", F.coalesce("verdict", F.lit(default)))
