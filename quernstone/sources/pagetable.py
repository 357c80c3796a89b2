"""The page table in buckets of titles: merges rewrite the buckets that they touch, look-ups read one.

Files lie in ``data/table_version=V/table_bucket=B/status=S``. A manifest says
which version of each bucket counts. A merge reads and rewrites the buckets of
the titles that it brings, as a new version, and then publishes a manifest, in
one step: until then readers see the old table, and so they do after a merge
that was killed. Within a bucket rows lie apart by status, so a row that
changes its status moves, and a scan of one status reads its files only.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from ..storage import Manifests, delete, materialize, names_in

#: Buckets of a new table. A bucket should be what one task reads in seconds: take more for a large wiki.
BUCKETS = 64
_VERSION, _BUCKET, _STATUS = "table_version", "table_bucket", "status"


class PageTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.manifests = Manifests(spark, self.path)

    # ── reading ─────────────────────────────────────────────────────────────

    def versions(self) -> list[int]:
        return self.manifests.versions()

    def exists(self) -> bool:
        return bool(self.versions())

    def _manifest(self, version: int | None = None) -> dict:
        found = self.manifests.read(version)
        if found is None:
            raise FileNotFoundError(self.path)
        return found

    def _bucket(self, title: Column, buckets: int) -> Column:
        return F.coalesce(F.crc32(title.cast("binary")) % buckets, F.lit(0)).cast("int")

    def _scan(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        data, wanted = f"{self.path}/data", manifest["buckets"] if buckets is None else {str(b): manifest["buckets"][str(b)] for b in buckets if str(b) in manifest["buckets"]}
        paths = [f"{data}/{_VERSION}={v}/{_BUCKET}={b}" for b, v in sorted(wanted.items(), key=lambda x: int(x[0]))]
        if not paths:
            return self.spark.createDataFrame([], schema)
        full = StructType(list(schema.fields)).add(_VERSION, StringType()).add(_BUCKET, IntegerType())
        return self.spark.read.schema(full).option("basePath", data).parquet(*paths).select(*schema.names)

    def read(self, version: int | None = None) -> DataFrame:
        """All pages, of the latest version by default."""
        return self._scan(self._manifest(version))

    def get(self, title: str) -> DataFrame:
        """The page of a title: a scan of its bucket."""
        manifest = self._manifest()
        return self._scan(manifest, [zlib.crc32(title.encode()) % manifest["n"]]).where(F.col("title") == title)

    def revision(self, title: str) -> DataFrame:
        """One row: the revision of a page, 0 if there is none."""
        return self.get(title).agg(F.coalesce(F.max("revision_id"), F.lit(0)).cast("long").alias("revision_id"))

    def by_status(self, status: str) -> DataFrame:
        """Pages of a status: a scan of the files that hold them."""
        return self.read().where(F.col(_STATUS) == status)

    # ── writing ─────────────────────────────────────────────────────────────

    def _write(self, rows: DataFrame, n: int) -> tuple[str, list[int]]:
        """Write rows as a new version of their buckets; its name and the buckets that have rows."""
        name = f"{max(self.versions(), default=-1) + 1}-{uuid.uuid4().hex[:8]}"
        target = f"{self.path}/data/{_VERSION}={name}"
        out = rows.withColumn(_BUCKET, self._bucket(F.col("title"), n)).hint("rebalance", _BUCKET).sortWithinPartitions(_BUCKET, _STATUS, "title")
        out.write.partitionBy(_BUCKET, _STATUS).parquet(target)
        return name, [int(x.split("=")[1]) for x in names_in(self.spark, target) if x.startswith(f"{_BUCKET}=")]

    def _publish(self, version: int, n: int, buckets: dict, schema: StructType, batch: int | None) -> int:
        nullable = StructType.fromJson({"type": "struct", "fields": [f.jsonValue() | {"nullable": True} for f in schema.fields]})
        self.manifests.publish(version, {"n": n, "buckets": buckets, "schema": nullable.jsonValue(), "batch": batch})
        return version

    def replace(self, rows: DataFrame, buckets: int = BUCKETS, batch: int | None = None) -> int:
        """Make ``rows`` the whole table; the number of the new version."""
        version = max(self.versions(), default=-1) + 1
        name, have = self._write(rows, buckets)
        return self._publish(version, buckets, {str(b): name for b in have}, rows.schema, batch)

    def merge(self, changes: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], batch: int | None = None) -> int:
        """Merge rows (title and more) into the table; the number of the current version.

        ``combine(pages, changes)`` gives the new rows of the buckets that
        ``changes`` touch, out of the rows that are in them; it must not make
        rows of other titles. A batch number that was merged before is not
        merged again. FileExistsError if another writer was faster: merge again.
        """
        version = max(self.versions(), default=-1)
        manifest = self._manifest(version)
        if batch is not None and manifest["batch"] is not None and manifest["batch"] >= batch:
            return version
        changes = materialize(changes, "changes")
        touched = sorted(r["b"] for r in changes.select(self._bucket(F.col("title"), manifest["n"]).alias("b")).distinct().collect())
        if not touched:
            return version
        rows = combine(self._scan(manifest, touched), changes)
        name, have = self._write(rows, manifest["n"])
        buckets = {b: v for b, v in manifest["buckets"].items() if int(b) not in touched} | {str(b): name for b in have}
        return self._publish(version + 1, manifest["n"], buckets, rows.schema, manifest["batch"] if batch is None else batch)

    def remove_old(self, keep: int = 3) -> None:
        """Forget all versions but the last ones, and delete files that none of these needs, those of failed merges included."""
        for v in self.versions()[:-keep]:
            delete(self.spark, f"{self.manifests.path}/{v:010d}.json")
        used = {x for v in self.versions() for x in self._manifest(v)["buckets"].items()}
        names = {x for _, x in used}
        newest = max(self.versions(), default=-1)
        for folder in names_in(self.spark, f"{self.path}/data"):
            name = folder.split("=", 1)[1]
            if name not in names and int(name.split("-")[0]) <= newest:  # a higher number may be a merge that is at work
                delete(self.spark, f"{self.path}/data/{folder}")
            elif name in names:
                for b in names_in(self.spark, f"{self.path}/data/{folder}"):
                    if b.startswith(f"{_BUCKET}=") and (b.split("=")[1], name) not in used:
                        delete(self.spark, f"{self.path}/data/{folder}/{b}")
