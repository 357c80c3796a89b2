"""Files: Markdown corpora in and out, JSON and text reports, images, manifests, rewriting."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.window import Window

from .. import config as C
from ..storage import materialize

#: Parts of names of images that are no pictures of the subject, and how many images of a page are looked at: fixed values.
NO_PICTURE, IMAGES_TRIED = (".svg", "logo", "icon", "symbol"), 3
LARGE_FILE = 20 << 20
#: Names of staging folders begin so; the file in them that names the tasks' folders that count.
STAGING, COUNTED = ".staging-", "counted"
#: Files or folders for a task; rows of a batch of a listing; bytes of a batch of contents.
DEALT, LISTED, READ_BYTES = 4096, 2048, 4 << 20
#: Files that are uploaded by name, and folders that a manifest leaves out.
UPLOADED = (".gitignore", "LICENSE", "README.md", "requirements.txt", "requirements-dev.txt")
IGNORED = (".git", "__pycache__", ".pytest_cache", "node_modules", ".venv")


def _children(fs: pafs.FileSystem, folder: str) -> Iterator[tuple[str, bool]]:
    """(name, is_folder) of what a folder holds: a stream where the file system is local, elsewhere what one request gives."""
    if isinstance(fs, pafs.LocalFileSystem):
        with os.scandir(folder) as found:
            for f in found:
                if f.is_dir() or f.is_file():
                    yield f.name, f.is_dir()
    else:
        for f in fs.get_file_info(pafs.FileSelector(folder)):
            if f.type in (pafs.FileType.Directory, pafs.FileType.File):
                yield f.base_name, f.type == pafs.FileType.Directory


def _below(fs: pafs.FileSystem, folder: str) -> Iterator[str]:
    """The paths of all files below a folder, as a stream."""
    for name, is_folder in _children(fs, folder):
        if is_folder:
            yield from (f"{name}/{p}" for p in _below(fs, f"{folder}/{name}"))
        else:
            yield name


def _deal(rows: DataFrame, n: int) -> DataFrame:
    """``n`` rows dealt out evenly: tasks for all cores, more of them with more rows."""
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // DEALT)))


def _levels(spark: SparkSession, root: str, folders: list[str], deep: bool = True) -> list[tuple[DataFrame, int]]:
    """(path, is_folder) of what lies in ``folders`` below ``root``, and so on down: a table for each level and its number of folders.

    Each level's folders are dealt out to tasks, which pass names on as they come: neither the driver nor a task holds a
    tree, and there are no more tasks for many small folders than for one large.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _file_system(root)
        rows: list[tuple[str, bool]] = []
        for batch in batches:
            for folder in batch["path"]:
                for name, is_folder in _children(fs, f"{base}/{folder}".rstrip("/")):
                    if not name.startswith(STAGING):
                        rows.append((f"{folder}/{name}".lstrip("/"), is_folder))
                    if len(rows) >= LISTED:
                        yield pd.DataFrame(rows, columns=["path", "is_folder"])
                        rows = []
        if rows:
            yield pd.DataFrame(rows, columns=["path", "is_folder"])

    levels, above, n = [], spark.createDataFrame([(f,) for f in folders], "path string"), len(folders)
    while n:
        level = materialize(_deal(above, n).mapInPandas(run, "path string, is_folder boolean"), "listing")
        above = level.where("is_folder").select("path")
        n = above.count() if deep else 0
        levels.append((level, n))
    return levels


def _files_of(levels: list[tuple[DataFrame, int]]) -> DataFrame:
    """(path) of the files of all levels."""
    rows = levels[0][0]
    for level, _ in levels[1:]:
        rows = rows.unionByName(level)
    return rows.where("NOT is_folder").select("path")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, size) of all files below ``root``, contents unread, empty ones included; names are taken when it is called, sizes when it is read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _file_system(root)
        for batch in batches:
            for i in range(0, len(batch), LISTED):
                found = fs.get_file_info([f"{base}/{p}" for p in batch["path"][i : i + LISTED]])
                rows = [(f.path[len(base) + 1 :], f.size) for f in found if f.type == pafs.FileType.File]
                yield pd.DataFrame(rows, columns=["path", "size"]).astype({"size": "int64"})

    names = _files_of(_levels(spark, root, [""]))
    return _deal(names, names.count()).mapInPandas(run, "path string, size long")


def _contents(names: DataFrame, root: str) -> DataFrame:
    """(path, raw) of files (path) below ``root``; batches end at ``READ_BYTES``, whatever the number of files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(root)
        paths, texts, size = [], [], 0
        schema = pa.schema([("path", pa.string()), ("raw", pa.binary())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with fs.open_input_stream(f"{base}/{path}", compression=None) as f:
                    text = f.read()
                paths.append(path)
                texts.append(text)
                size += len(text) + len(path)
                if size >= READ_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.binary())], schema=schema)
                    paths, texts, size = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.binary())], schema=schema)

    return _deal(names, names.count()).mapInArrow(run, "path string, raw binary").select("path", F.col("raw").cast("string").alias("raw"))


def read_markdown(spark: SparkSession, root: str, dirs: tuple[str, ...] | None = C.INDEX_DIRS) -> DataFrame:
    """(path, directory, file_name, raw) of ``*.md`` files.

    With ``dirs`` only these folders count, without their sub-folders; those
    that are missing are left out, but a missing root is an error. With None
    the whole tree is read. Empty files are rows with an empty text. Names are
    listed and dealt out first, so tasks are as many as the files need and the
    driver holds no listing.
    """
    fs, base = _file_system(root)
    if fs.get_file_info(base).type != pafs.FileType.Directory:
        raise FileNotFoundError(root)
    folders = [""] if dirs is None else [d for d in dirs if fs.get_file_info(f"{base}/{d}").type == pafs.FileType.Directory]
    if not folders:
        return spark.createDataFrame([], "path string, directory string, file_name string, raw string")
    names = _files_of(_levels(spark, root, folders, deep=dirs is None)).where(F.endswith("path", F.lit(".md")))
    top = F.lit(re.sub("^file:/+", "/", root).rstrip("/") + "/")
    rows = _contents(names, root).select(F.concat(top, F.col("path")).alias("path"), "raw")
    return rows.select("path", F.element_at(F.split("path", "/"), -2).alias("directory"), F.substring_index("path", "/", -1).alias("file_name"), "raw")


class _Done(WriterCommitMessage):
    def __init__(self, folder: str):
        self.folder = folder


def inside(path: str | None) -> str:
    """A path below the root, tidied; an error if it is absolute, empty or leaves the root."""
    parts = [p for p in (path or "").split("/") if p not in ("", ".")]
    if not parts or path.startswith("/") or ".." in parts:
        raise ValueError(f"outside of the folder: {path!r}")
    return "/".join(parts)


def put(root: str, path: str, content: str | bytes) -> str:
    """Write a file below ``root``, a local folder or an address of any file system that Arrow knows; complete or absent, however many tasks write it."""
    target = inside(path)
    fs, base = _file_system(root)
    full = f"{base}/{target}"
    fs.create_dir(full.rsplit("/", 1)[0], recursive=True)
    part = f"{full}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as f:
        f.write(content.encode() if isinstance(content, str) else content)
    fs.move(part, full)
    return full


def get(root: str, path: str) -> bytes:
    """The contents of a file below ``root``."""
    fs, base = _file_system(root)
    with fs.open_input_stream(f"{base}/{inside(path)}") as f:
        return f.read()


def count_files(root: str, folder: str, ending: str) -> int:
    """How many files of a folder below ``root`` end so; 0 if there is no such folder."""
    fs, base = _file_system(root)
    return sum(f.base_name.endswith(ending) for f in fs.get_file_info(pafs.FileSelector(f"{base}/{inside(folder)}", allow_not_found=True)))


def remove(root: str, path: str) -> bool:
    """Delete a file below ``root``; whether it was there."""
    fs, base = _file_system(root)
    there = fs.get_file_info(f"{base}/{inside(path)}").type == pafs.FileType.File
    if there:
        fs.delete_file(f"{base}/{inside(path)}")
    return there


def _file_system(root: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", root):
        fs, base = pafs.FileSystem.from_uri(root if "://" in root else root.replace(":", "://", 1))
    else:
        fs, base = pafs.LocalFileSystem(), os.path.abspath(root)
    return fs, base.rstrip("/")


class FileWriter(DataSourceWriter):
    """Writes rows (path, content) as files into the staging folder that ``write_files`` names, each task into a folder of its own.

    When all have succeeded, the folders that count are named in ``COUNTED``;
    after a failure nothing is left.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.staging = options["path"]

    def write(self, rows: Iterator) -> WriterCommitMessage:
        own = uuid.uuid4().hex
        fs, base = _file_system(f"{self.staging}/{own}")
        made = _maker(fs)
        for row in rows:
            full = f"{base}/{inside(row['path'])}"
            made(full.rsplit("/", 1)[0])
            with fs.open_output_stream(full, compression=None) as f:
                f.write(row["content"].encode())
        return _Done(own)

    def commit(self, messages: list[_Done]) -> None:
        put(self.staging, COUNTED, "\n".join(m.folder for m in messages))

    def abort(self, messages: list) -> None:
        _drop(self.staging)


def _maker(fs: pafs.FileSystem) -> Callable[[str], None]:
    """Makes folders, none twice in a row."""
    return lru_cache(maxsize=256)(lambda folder: fs.create_dir(folder, recursive=True))


def _drop(folder: str) -> None:
    fs, base = _file_system(folder)
    if fs.get_file_info(base).type == pafs.FileType.Directory:
        fs.delete_dir(base)


class FilesSource(DataSource):
    """``df.write.format("quernstone_files").save(staging)`` for (path, content); the folder is one that all executors share."""

    @classmethod
    def name(cls) -> str:
        return "quernstone_files"

    def schema(self) -> str:
        return "path string, content string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return FileWriter(self.options, overwrite)


def write_files(files: DataFrame, root: str) -> None:
    """Write (path, content), each path below ``root``: none of them if a task fails.

    Tasks write below a staging folder; when all have succeeded, tasks again
    move what they wrote to its place. What an attempt has written that did
    not count is dropped.
    """
    spark, staging = files.sparkSession, f"{root.rstrip('/')}/{STAGING}{uuid.uuid4().hex}"

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _file_system(root)
        made = _maker(fs)
        for batch in batches:
            for own in batch["own"]:
                top, n = f"{_file_system(staging)[1]}/{own}", 0
                for path in _below(fs, top) if fs.get_file_info(top).type == pafs.FileType.Directory else ():
                    made(f"{base}/{path}".rsplit("/", 1)[0])
                    try:
                        fs.move(f"{top}/{path}", f"{base}/{path}")
                    except FileNotFoundError:  # another attempt of this task was first
                        if fs.get_file_info(f"{base}/{path}").type != pafs.FileType.File:
                            raise
                    n += 1
                _drop(f"{staging}/{own}")
                yield pd.DataFrame({"own": [own], "n": [n]})

    spark.dataSource.register(FilesSource)
    try:
        files.select("path", "content").write.format("quernstone_files").mode("append").save(staging)
        own = get(staging, COUNTED).decode().split("\n")
        spark.createDataFrame([(o,) for o in own], "own string").repartition(len(own)).mapInPandas(move, "own string, n long").agg(F.sum("n")).collect()
    finally:
        _drop(staging)


def export_files(files: DataFrame, root: str) -> DataFrame:
    """(path, error) of files (path, content) as they are written: a file that can't be written has an error and stops no other.

    Errors are ``no content``, ``outside`` for paths that leave the folder, or
    the system's message; null is success.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            errors = []
            for path, content in zip(rows["path"], rows["content"], strict=True):
                try:
                    inside(path)
                    errors.append("no content" if content is None else None)
                    if content is not None:
                        put(root, path, content)
                except ValueError:
                    errors.append("outside")
                except OSError as e:
                    errors[-1] = str(e)
            yield pd.DataFrame({"path": rows["path"], "error": pd.Series(errors, dtype=object)})

    return files.select("path", "content").mapInPandas(run, "path string, error string")


def download_images(wanted: DataFrame, client: str, root: str) -> DataFrame:
    """(title, path, outcome) of images (title, path, url) that are stored below ``root``.

    ``client`` names a callable ``get(url) -> (status, headers, body)`` that
    executors can import. Outcomes are ``none`` without an address, ``exists``
    for a file that is there already, ``stored``, or ``failed``.
    """
    from .api import _client

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = _client(client)
        fs, base = _file_system(root)
        for rows in batches:
            outcomes = []
            for path, url in zip(rows["path"], rows["url"], strict=True):
                if not url:
                    outcomes.append("none")
                    continue
                try:
                    if fs.get_file_info(f"{base}/{inside(path)}").type == pafs.FileType.File:
                        outcomes.append("exists")
                        continue
                    status, _, body = get(url)
                    if status == 200:
                        put(root, path, body)
                    outcomes.append("stored" if status == 200 else "failed")
                except (OSError, ValueError):
                    outcomes.append("failed")
            yield pd.DataFrame({"title": rows["title"], "path": rows["path"], "outcome": outcomes})

    return wanted.select("title", "path", "url").mapInPandas(run, "title string, path string, outcome string")


def clean_output(spark: SparkSession, root: str) -> None:
    """Delete a tree: its files by tasks, then its folders, the deepest first; the driver deletes what is left of it, an empty folder."""
    fs, base = _file_system(root)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, top = _file_system(root)
        for batch in batches:
            for path, is_folder in zip(batch["path"], batch["is_folder"], strict=True):
                try:
                    (own.delete_dir if is_folder else own.delete_file)(f"{top}/{path}")
                except FileNotFoundError:  # by an earlier attempt
                    pass
            yield batch[["path"]]

    if fs.get_file_info(base).type == pafs.FileType.Directory:
        for level, n in reversed(_levels(spark, root, [""])):
            for kind in (~F.col("is_folder"), F.col("is_folder")):
                gone = level.where(kind)
                _deal(gone, gone.count()).mapInPandas(run, "path string").agg(F.count("*")).collect()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    hadoop(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop(root), True)


def write_document(rows: DataFrame, column: str, path: str, *order: Column, head: str = "", between: str = "\n", tail: str = "\n") -> None:
    """Texts of a column as one file, in order: ``head``, the texts with ``between`` between them, ``tail``.

    Rows are made once, then Spark sorts them by ranges, for which it reads them
    twice, and writes the ranges in parallel; the driver then appends the parts
    to each other as streams of bytes. The file is complete or as it was before.
    """
    spark, parts = rows.sparkSession, f"{path}.parts-{uuid.uuid4().hex}"
    materialize(rows, "unsorted").orderBy(*order).select(column).write.option("lineSep", between).text(parts)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(conf)
    found = sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(hadoop(parts)))
    found = [(n, size) for n, size in found if n.startswith("part-") and size]
    out = fs.create(hadoop(f"{parts}/whole"))
    out.write(bytearray(head.encode()))
    for i, (name, size) in enumerate(found):
        into = fs.open(hadoop(f"{parts}/{name}"))
        jvm.org.apache.commons.io.IOUtils.copyLarge(into, out, 0, size - len(between.encode()) * (i == len(found) - 1))
        into.close()
    out.write(bytearray(tail.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    target = fs.makeQualified(hadoop(path))
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(fs.makeQualified(hadoop(f"{parts}/whole")), target, options)
    fs.delete(hadoop(parts), True)


def write_report(lines: DataFrame, path: str) -> None:
    """(line_no, line) as one text file, however many lines there are."""
    write_document(lines, "line", path, F.col("line_no"))


def write_json(rows: DataFrame, column: str, path: str, *order: Column) -> None:
    """JSON texts as one array."""
    write_document(rows, column, path, *order, head="[\n", between=",\n", tail="\n]\n")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(place, value) of an array that :func:`write_json` wrote, from place 0; a line is an element, so that tasks read parts of the file.

    Lines are numbered within each part of the file, and parts by the lines before them.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_block_start").alias("part"))
    lines = materialize(lines.where("value NOT IN ('[', ']', '')").withColumn("id", F.monotonically_increasing_id()), "lines")
    parts = lines.groupBy("part").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = lines.join(F.broadcast(parts.select("part", "first", before.alias("before"))), "part")  # a row for each block of the file
    return rows.select((F.col("id") - F.col("first") + F.col("before")).alias("place"), F.from_json(F.regexp_replace("value", ",$", ""), schema).alias("value"))


def is_picture(title: Column) -> Column:
    """Whether an image's name may be a picture of the subject."""
    return ~F.exists(F.lit(list(NO_PICTURE)), lambda s: F.contains(F.lower(title), s))


def image_choice(page_image: Column, images: Column) -> Column:
    """The page's own image, else the first of its first three that is a picture; null if there is none."""
    fits = F.filter(F.slice(images, 1, IMAGES_TRIED), is_picture)
    return F.coalesce(F.nullif(page_image, F.lit("")), F.get(fits, F.lit(0)))


def image_extension(url: Column) -> Column:
    """The extension of an image address; .jpg if it has none that is known."""
    found = F.lower(F.regexp_extract(url, r"(?i)\.(jpg|jpeg|png|webp|gif)(?:[?#].*)?$", 0))
    return F.when(found == "", ".jpg").otherwise(F.regexp_replace(found, r"[?#].*$", ""))


def manifest(spark: SparkSession, root: str, code_dirs: tuple[str, ...] = ("tools/",)) -> DataFrame:
    """(path, size, kind, is_large) of a tree: ignored, uploadable or review; paths are below ``root``. Contents are not read; empty files are listed, too."""
    rows = list_files(spark, root)
    rows = rows.where(~F.exists(F.split("path", "/"), lambda p: p.isin(*IGNORED)))
    path = F.col("path")
    ignored = F.regexp_like(path, F.lit(r"quality_report|deep_scan_report|auto_fix_report|\.(pyc|db|sqlite|log)$"))
    upload = F.endswith(path, F.lit(".py")) | path.isin(*UPLOADED)
    for d in code_dirs:
        upload = upload | F.startswith(path, F.lit(d))
    kind = F.when(ignored, "ignored").when(upload, "uploadable").otherwise("review")
    return rows.select("path", "size", kind.alias("kind"), ((kind != "ignored") & (F.col("size") > LARGE_FILE)).alias("is_large"))


def rewrite(candidates: DataFrame, model: Callable[[str], str]) -> DataFrame:
    """(path, front, new_body) of candidates with a request; ``model`` is called by executors, an empty answer keeps the file (null)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"path": rows["path"], "front": rows["front"], "new_body": [model(r) or None for r in rows["request"]]})

    return candidates.select("path", "front", "request").mapInPandas(run, "path string, front string, new_body string")


def without_tags(front: Column, tags: tuple[str, ...]) -> Column:
    """Front matter (as YAML writes it) without the items of lists that are any of ``tags``."""
    return F.array_join(F.filter(F.split(front, "\n", -1), lambda l: ~F.regexp_replace(l, r"^\s*-\s+['\"]?(.*?)['\"]?\s*$", "$1").isin(*tags) | ~F.regexp_like(l, F.lit(r"^\s*-\s"))), "\n")


def rewritten_files(rewritten: DataFrame, drop_tags: tuple[str, ...] = (), dry: bool = False) -> DataFrame:
    """(path, content) of answered candidates, without the categories ``drop_tags``; a dry run gives (path, n_chars) and no contents."""
    rows = rewritten.where("new_body IS NOT NULL")
    if dry:
        return rows.select("path", F.length("new_body").cast("long").alias("n_chars"))
    front = without_tags(F.col("front"), drop_tags) if drop_tags else F.col("front")
    return rows.select("path", F.concat(F.lit("---\n"), F.regexp_replace(front, r"\A\n+", ""), F.lit("---\n\n"), F.col("new_body"), F.lit("\n")).alias("content"))
