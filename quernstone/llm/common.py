"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import materialize, read_table, scratch

__all__ = ["hashed", "lower_ascii", "materialize", "scratch", "table"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Rows of a shuffle partition up to which a join may hold its slim side in memory (some 100 bytes a row).
HASH_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus, read by Spark so that any file system works.

    A small one is dealt out to all cores (:func:`quernstone.storage.read_table`).
    """
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    """``col`` with A-Z lower-cased and every other character unchanged."""
    return F.translate(col, UPPER, LOWER)


def hashed(rows: DataFrame, n: int) -> DataFrame:
    """``rows``, at most ``n`` with keys that are nearly unique, as the side of a join that is held in memory.

    That spares sorting the other side, whole texts. It can't spill, so beyond
    HASH_ROWS rows a partition the join is left to Spark, which sorts both.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.hint("shuffle_hash") if n <= HASH_ROWS * partitions else rows
