"""The page cache as an SQLite file: a data source that reads it in ranges of row ids, and a sink.

SQLite is a file on one machine; this is for exchanging caches. The engine's
own tables are Parquet. A large table is exchanged as many files, each written
and read by a task (:func:`write_shards`, :func:`read_shards`).
"""

from __future__ import annotations

import contextlib
import sqlite3
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import files

#: Columns of the cached pages with their SQLite types; categories are a JSON list, times ISO text: fixed values.
COLUMNS = (
    ("title", "TEXT PRIMARY KEY"),
    ("page_id", "INTEGER"),
    ("revision_id", "INTEGER"),
    ("updated", "TEXT"),
    ("categories", "TEXT"),
    ("wikitext", "TEXT"),
    ("markdown", "TEXT"),
    ("url", "TEXT"),
    ("redirect_target", "TEXT"),
    ("status", "TEXT"),
    ("error", "TEXT"),
    ("created_at", "TEXT"),
    ("updated_at", "TEXT"),
)
#: Columns of the other two tables, and the indexes: fixed values.
CATEGORY_COLUMNS = (("title", "TEXT PRIMARY KEY"), ("page_id", "INTEGER"), ("depth", "INTEGER"), ("parent", "TEXT"), ("crawled", "INTEGER"), ("created_at", "TEXT"))
STAT_COLUMNS = (("key", "TEXT PRIMARY KEY"), ("value", "TEXT"))
TABLES = {"pages": COLUMNS, "categories": CATEGORY_COLUMNS, "stats": STAT_COLUMNS}
INDEXES = (("idx_pages_status", "pages", "status"), ("idx_pages_revision", "pages", "revision_id"), ("idx_categories_depth", "categories", "depth"), ("idx_categories_crawled", "categories", "crawled"))


def _schema(table: str) -> str:
    return ", ".join(f"{n} {'bigint' if t == 'INTEGER' else 'string'}" for n, t in TABLES[table])


class _Range(InputPartition):
    def __init__(self, low: int, high: int):
        super().__init__((low, high))
        self.low, self.high = low, high


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.parts, self.table = options["path"], int(options.get("partitions", 4)), options.get("table", "pages")

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(self.path) as db:
            low, high = db.execute(f"SELECT coalesce(min(rowid), 0), coalesce(max(rowid), -1) FROM {self.table}").fetchone()
        step = max(1, -(-(high - low + 1) // self.parts))
        return [_Range(a, min(high + 1, a + step)) for a in range(low, high + 1, step)] or [_Range(0, 0)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        with sqlite3.connect(self.path) as db:
            have = {r[1] for r in db.execute(f"PRAGMA table_info({self.table})")}
            names = ", ".join(n if n in have else f"NULL AS {n}" for n, _ in TABLES[self.table])
            yield from db.execute(f"SELECT {names} FROM {self.table} WHERE rowid >= ? AND rowid < ?", (partition.low, partition.high))


class SqliteSource(DataSource):
    """``spark.read.format("quernstone_sqlite").option("path", file).option("table", "pages")``; tables are pages, categories and stats."""

    @classmethod
    def name(cls) -> str:
        return "quernstone_sqlite"

    def schema(self) -> str:
        return _schema(self.options.get("table", "pages"))

    def reader(self, schema) -> DataSourceReader:
        return SqliteReader(self.options)


def read_table(spark: SparkSession, path: str, table: str, partitions: int = 4) -> DataFrame:
    """A table of the cache as it is stored."""
    spark.dataSource.register(SqliteSource)
    return spark.read.format("quernstone_sqlite").option("path", path).option("table", table).option("partitions", str(partitions)).load()


def read_pages(spark: SparkSession, path: str, partitions: int = 4) -> DataFrame:
    """Cached pages, typed; broken JSON and times are null."""
    return typed(read_table(spark, path, "pages", partitions))


def _stored(name: str) -> Column:
    """A column as SQLite stores it: categories are a JSON list, times ISO text, truths 0 and 1."""
    if name == "categories":
        return F.to_json(name).alias(name)
    return F.col(name).cast({"crawled": "int", "updated": "string", "created_at": "string", "updated_at": "string"}[name]).alias(name) if name in ("crawled", "updated", "created_at", "updated_at") else F.col(name)


def create(db: sqlite3.Connection) -> None:
    """The three tables and their indexes, where they are missing."""
    db.execute("PRAGMA journal_mode = WAL")
    for table, columns in TABLES.items():
        db.execute(f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(f'{a} {b}' for a, b in columns)})")
    for name, table, column in INDEXES:
        db.execute(f"CREATE INDEX IF NOT EXISTS {name} ON {table} ({column})")


def write_table(rows: DataFrame, path: str, table: str = "pages") -> int:
    """Upsert rows into a table of an SQLite file by its key; a row's creation time survives. Rows stream through the driver, one partition at a time."""
    names = [n for n, _ in TABLES[table] if n in rows.columns]
    key = TABLES[table][0][0]
    changes = ", ".join(f"{n} = excluded.{n}" for n in names if n not in (key, "created_at"))
    changes = f"UPDATE SET {changes}" if changes else "NOTHING"
    rows = rows.select(*(_stored(n) for n in names))
    n = 0
    with sqlite3.connect(path) as db:
        create(db)
        for row in rows.toLocalIterator():
            db.execute(f"INSERT INTO {table} ({', '.join(names)}) VALUES ({', '.join('?' * len(names))}) ON CONFLICT ({key}) DO {changes}", tuple(row))
            n += 1
    return n


# ── one file for each task ──────────────────────────────────────────────────


def write_shards(rows: DataFrame, root: str, table: str = "pages") -> DataFrame:
    """Write rows as SQLite files below ``root``, one for each partition, made by the tasks: (path, n_rows).

    Rows of a key go to one file (the last one counts), so files can be merged
    by upsert in any order. The root is on any file system that Arrow knows.
    """
    names = [n for n, _ in TABLES[table] if n in rows.columns]
    key = TABLES[table][0][0]
    slim = rows.select(*(_stored(n) for n in names)).repartition(key)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with tempfile.TemporaryDirectory() as folder:
            part, n = f"{folder}/part.db", 0
            with contextlib.closing(sqlite3.connect(part)) as db:
                create(db)
                db.execute("PRAGMA journal_mode = DELETE")
                for batch in batches:
                    values = batch.astype(object).where(batch.notna(), None)
                    db.executemany(f"INSERT OR REPLACE INTO {table} ({', '.join(names)}) VALUES ({', '.join('?' * len(names))})", values.itertuples(index=False, name=None))
                    n += len(batch)
                db.commit()
            if n:
                name = f"{table}-{TaskContext.get().partitionId():05d}.db"
                with open(part, "rb") as f:
                    files.put(root, name, f.read())
                yield pd.DataFrame({"path": [name], "n_rows": [n]})

    return slim.mapInPandas(run, "path string, n_rows long")


def read_shards(spark: SparkSession, root: str, table: str = "pages") -> DataFrame:
    """A table out of all files of :func:`write_shards` below ``root``, a task for some of the files each."""
    paths = files.list_files(spark, root).where(F.col("path").rlike(rf"(^|/){table}-\d+\.db$")).select("path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [n for n, _ in TABLES[table]]
        for batch in batches:
            for path in batch["path"]:
                with tempfile.TemporaryDirectory() as folder:
                    with open(f"{folder}/part.db", "wb") as f:
                        f.write(files.get(root, path))
                    with contextlib.closing(sqlite3.connect(f"{folder}/part.db")) as db:
                        found = db.execute(f"SELECT {', '.join(columns)} FROM {table}")
                        while rows := found.fetchmany(10_000):
                            yield pd.DataFrame(rows, columns=columns).astype({n: "Int64" for n, t in TABLES[table] if t == "INTEGER"})

    return paths.repartition(spark.sparkContext.defaultParallelism).mapInPandas(run, _schema(table))


def remove_shards(spark: SparkSession, root: str) -> DataFrame:
    """Delete all files of :func:`write_shards` below ``root``: (path, removed)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "removed": [files.remove(root, p) for p in batch["path"]]})

    return files.list_files(spark, root).where(F.endswith("path", F.lit(".db"))).select("path").mapInPandas(run, "path string, removed boolean")


def typed(raw: DataFrame) -> DataFrame:
    """Pages as they are stored, typed; broken JSON and times are null."""
    times = {c: F.try_to_timestamp(c) for c in ("updated", "created_at", "updated_at")}
    return raw.withColumns(times | {"categories": F.from_json("categories", "array<string>")})


def write_pages(pages: DataFrame, path: str) -> int:
    return write_table(pages, path, "pages")


def clean(path: str) -> None:
    """Delete all that is cached: pages, categories and statistics."""
    with sqlite3.connect(path) as db:
        create(db)
        for table in TABLES:
            db.execute(f"DELETE FROM {table}")
