"""Scratch tables on shared storage."""

from __future__ import annotations

import atexit
import contextlib
import json
import re
import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_roots: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one of our own only where it is unset and all runs in this one process."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="quernstone-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended; the folder is the cluster's to clear then
        delete(spark, path)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, in order; none if there is no such folder."""
    fs, target = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


class Manifests:
    """Numbered versions of a stored structure: small JSON documents, each complete or absent.

    A version counts from the moment its document is there, and a number is
    given once: of two writers of the same version the second fails.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path.rstrip('/')}/manifest"

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in names_in(self.spark, self.path) if re.fullmatch(r"\d+\.json", n)]

    def read(self, version: int | None = None) -> dict | None:
        """The document of a version, of the latest by default; None if there is none."""
        have = self.versions()
        if not have:
            return None
        fs, target = _file_system(self.spark, f"{self.path}/{have[-1] if version is None else version:010d}.json")
        stream = fs.open(target)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, version: int, document: dict) -> None:
        """Make ``document`` the version; FileExistsError if another writer was first."""
        jvm, name = self.spark.sparkContext._jvm, f"{self.path}/{version:010d}.json"
        fs, part = _file_system(self.spark, f"{self.path}/.{uuid.uuid4().hex}.part")
        out = fs.create(part)
        out.write(bytearray(json.dumps(document).encode()))
        out.close()
        target = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(name))
        part = fs.makeQualified(part)
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(part, target, options)
        except Exception as e:
            fs.delete(part, False)
            if "FileAlreadyExists" in str(e) or "already exists" in str(e):
                raise FileExistsError(f"version {version} was written by another") from e
            raise


#: Bytes of a table for each core below which its rows are dealt out: a scan has no more tasks with rows than there are
#: row groups, and small tables have few.
DEAL_BYTES = 8 << 20


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; the rows of a small one, which may be a single row group, are dealt out to all cores."""
    rows, cores = spark.read.parquet(path), spark.sparkContext.defaultParallelism
    fs, target = _file_system(spark, path)
    size = fs.getContentSummary(target).getLength()
    return rows.repartition(cores) if size <= DEAL_BYTES * cores else rows


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Tables written inside are deleted at the end, but for those that the callable it gives was asked to keep."""
    outer, own, kept = _made.get(), [], set()
    token = _made.set(own)

    def keep(df: DataFrame) -> DataFrame:
        kept.add(own[-1])
        return df

    try:
        yield keep
    finally:
        _made.reset(token)
        for path in own:
            if path not in kept:
                _delete(spark, path)
            elif outer is not None:
                outer.append(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    root = f"{shared_dir(spark)}/quernstone/{spark.sparkContext.applicationId}"
    if root not in _roots:
        _roots.add(root)
        atexit.register(_delete, spark, root)
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if (made := _made.get()) is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)
