"""One file per row, and the headers of a folder's files, as data sources; the
files of a folder, listed and read by tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase
from functools import reduce
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from featurelab.session import materialize, workers_import

FILES_PER_TASK = 64
HEAD_BYTES = 1 << 16
SCAN_FILES = 4_096  # files, and bytes of them, that a task of a scan reads
SCAN_BYTES = 128 << 20
BATCH_BYTES = 4 << 20  # of contents that go to Spark at once
SAFE = "/~:@!$&'()*+,;=-._"
ODD = re.compile(f"[^{re.escape(SAFE)}A-Za-z0-9\x80-\U0010ffff]")  # escaped in a scan's uri


@dataclass
class Count(WriterCommitMessage):
    files: int


class DocumentWriter(DataSourceArrowWriter):
    """A task writes each of its rows to the file that the row names; a task
    that runs again writes the same files again.  The commit leaves
    ``_SUCCESS``, as Spark's own writers do."""

    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Count:
        where, root = fs.FileSystem.from_uri(self.path)
        made: set[str] = set()
        n = 0
        for b in iterator:
            for name, content in zip(b.column("name"), b.column("content")):
                if not name.is_valid:
                    raise ValueError("a document without a file name")
                target = f"{root}/{name.as_py()}"
                folder = target.rsplit("/", 1)[0]
                if folder not in made:
                    where.create_dir(folder, recursive=True)
                    made.add(folder)
                with where.open_output_stream(target, compression=None) as out:
                    if content.is_valid:
                        out.write(content.as_buffer())
                n += 1
        return Count(n)

    def commit(self, messages: list) -> None:
        where, root = fs.FileSystem.from_uri(self.path)
        where.create_dir(root, recursive=True)
        where.open_output_stream(f"{root}/_SUCCESS").close()

    def abort(self, messages: list) -> None:
        pass  # without _SUCCESS the folder does not count


class DocumentFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "document_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(self.options["path"])


@dataclass
class Paths(InputPartition):
    paths: list
    folder: str | None = None  # whose files are meant instead


class HeadReader(DataSourceReader):
    """The first line of every file; a task opens its files and reads no more
    than that of them.  Every folder in the given one is listed by a task."""

    def __init__(self, options: dict) -> None:
        self.path, self.suffix = options["path"].rstrip("/"), options.get("suffix", "")

    def _files(self, found: list) -> list[str]:
        return sorted(x.path for x in found
                      if x.is_file and not x.base_name.startswith(("_", ".")) and x.path.endswith(self.suffix))

    def partitions(self) -> list[Paths]:
        where, root = fs.FileSystem.from_uri(self.path)
        found = where.get_file_info(fs.FileSelector(root))
        files, folders = self._files(found), sorted(x.path for x in found if x.type == fs.FileType.Directory)
        return [Paths(files[i:i + FILES_PER_TASK]) for i in range(0, len(files), FILES_PER_TASK)] + [
            Paths([], x) for x in folders] or [Paths([])]

    def read(self, partition: Paths) -> Iterator[pa.RecordBatch]:
        where, _ = fs.FileSystem.from_uri(self.path)
        paths = partition.paths
        if partition.folder is not None:
            paths = self._files(where.get_file_info(fs.FileSelector(partition.folder, recursive=True)))
        for i in range(0, max(1, len(paths)), FILES_PER_TASK):
            some, heads = paths[i:i + FILES_PER_TASK], []
            for p in some:
                with where.open_input_stream(p) as f:
                    line = b""
                    while b"\n" not in line and (more := f.read(HEAD_BYTES)):
                        line += more
                heads.append(line.partition(b"\n")[0].rstrip(b"\r").decode("utf-8-sig", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array([quote(p, safe=SAFE) for p in some], pa.string()),
                                              pa.array(heads, pa.string())], ["path", "header"])


class FileHeads(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_heads"

    def schema(self) -> str:
        return "path string, header string"

    def reader(self, schema) -> HeadReader:
        return HeadReader(self.options)


def write_documents(df: DataFrame, path: str, name: str, content: str) -> None:
    """One file per row under ``path`` (IO9, IO10): column ``name`` is its
    place there, which should differ from row to row (the last of equal names
    stays), column ``content`` its bytes; null content is an empty file and a
    null name an error."""
    workers_import(df.sparkSession)
    df.sparkSession.dataSource.register(DocumentFiles)
    rows = df.select(F.col(name).cast("string").alias("name"), F.col(content).cast("binary").alias("content"))
    rows.write.format("document_files").mode("append").save(path)


def file_heads(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """(path without scheme, header) of every file under a folder."""
    workers_import(spark)
    spark.dataSource.register(FileHeads)
    return spark.read.format("file_heads").option("suffix", suffix).load(path)


def _seen(name: str) -> bool:
    """Names that Spark's scans do not pass over."""
    return not ((name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_"))


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path without scheme, size, millis) of the files in and under a folder
    whose names fit ``glob`` and that hold a byte, as Spark's scans find them.
    Folders are listed by tasks, level by level; only counts reach the driver."""
    workers_import(spark)
    uri = path.rstrip("/")

    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, _ = fs.FileSystem.from_uri(uri)
        for b in batches:
            for folder in b.column("path").to_pylist():
                found = [x for x in where.get_file_info(fs.FileSelector(folder)) if _seen(x.base_name)]
                found = [x for x in found if x.type == fs.FileType.Directory or (x.size and fnmatchcase(x.base_name, glob))]
                yield pa.RecordBatch.from_pydict(
                    {"path": [x.path for x in found], "folder": [not x.is_file for x in found], "size": [x.size or 0 for x in found],
                     "millis": [(x.mtime_ns or 0) // 1_000_000 for x in found]},
                    pa.schema([("path", pa.string()), ("folder", pa.bool_()), ("size", pa.int64()), ("millis", pa.int64())]))

    levels, folders, n = [], spark.createDataFrame([(fs.FileSystem.from_uri(uri)[1],)], "path string"), 1
    while n:
        dealt = folders.repartition(min(n, 4 * spark.sparkContext.defaultParallelism))
        found = materialize(dealt.mapInArrow(children, "path string, folder boolean, size long, millis long"))
        levels.append(found.where("not folder").select("path", "size", "millis"))
        folders = found.where("folder").select("path")
        n = folders.count()
    return reduce(DataFrame.unionByName, levels)


def scan_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path as a URI, uri with odd characters escaped, modificationTime, length,
    content) of the files of ``list_files``, dealt evenly over tasks."""
    uri = path.rstrip("/")
    files = list_files(spark, path, glob)
    n, size = files.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = max(1, min(n, max(spark.sparkContext.defaultParallelism, n // SCAN_FILES, size // SCAN_BYTES)))

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, _ = fs.FileSystem.from_uri(uri)
        local, parsed = where.type_name == "local", urlsplit(uri)
        plain, escaped = ("file:", "file://") if local else (f"{parsed.scheme}://{parsed.netloc}",) * 2

        def batch(held: list) -> pa.RecordBatch:
            paths = [p for p, _, _ in held]
            return pa.RecordBatch.from_arrays(
                [pa.array([plain + p for p in paths], pa.string()), pa.array([escaped + ODD.sub(lambda x: quote(x[0], safe=""), p) for p in paths], pa.string()),
                 pa.array([m for _, m, _ in held], pa.int64()), pa.array([c for _, _, c in held], pa.binary())],
                ["path", "uri", "millis", "content"])

        for b in batches:
            held, n_bytes = [], 0
            for p, m in zip(b.column("path").to_pylist(), b.column("millis").to_pylist()):
                with where.open_input_stream(p, compression=None) as f:
                    held.append((p, m, f.read()))
                n_bytes += len(held[-1][2])
                if n_bytes >= BATCH_BYTES:
                    yield batch(held)
                    held, n_bytes = [], 0
            if held:
                yield batch(held)

    read = files.repartition(parts).mapInArrow(contents, "path string, uri string, millis long, content binary")
    return read.select("path", "uri", F.timestamp_millis("millis").alias("modificationTime"),
                       F.octet_length("content").cast("bigint").alias("length"), "content")
