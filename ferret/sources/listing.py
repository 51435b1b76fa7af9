"""A folder as a table: a Python data source with every entry of one level, as on disk.

Spark's file sources leave out hidden names (``.x``, ``_x``), directories and, for binary
files, empty ones. This source lists them all: ``path, name, length, modificationTime,
is_dir, hidden``. Several folders are listed in parallel, a partition each; the names go
from the task to Spark in batches and never meet on the driver. It reads local folders
with ``os.scandir`` and others through ``pyarrow.fs``; for a store that neither knows,
``list_folder`` takes the listing of Spark's own file system instead, batch by batch.

``file_pieces`` gives the content of entries that Spark's readers skip, whatever their size.
"""

from __future__ import annotations

import datetime
import json
import os
import re
import sys
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, name string, length long, modificationTime timestamp, is_dir boolean"
#: Entries sent at once, files read at once in a task, and bytes of one such batch.
BATCH, READ_BYTES = 10_000, 32 << 20
#: Files of one reading task.
TASK_FILES = 256


def local_path(path: str) -> str | None:
    """The path on this machine of a path or file: URI (escapes decoded), else None."""
    parts = urlsplit(path)
    if parts.scheme == "file":
        return unquote(path[5:]) if not path.startswith("file://") else unquote(urlsplit(path).path)
    return path if len(parts.scheme) < 2 else None


def _remote(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


def _entries(folder: str):
    """(path, name, length, modification time, is_dir) of each entry, in no order."""
    here = local_path(folder)
    if here is not None:
        here = os.path.abspath(here)
        if not os.path.isdir(here):
            raise FileNotFoundError(folder)
        with os.scandir(here) as found:
            for e in found:
                try:
                    s = e.stat()
                except OSError:  # gone meanwhile, or a link to nothing
                    continue
                yield f"file:{here.rstrip('/')}/{e.name}", e.name, s.st_size, s.st_mtime, e.is_dir()
        return
    from pyarrow.fs import FileSelector, FileType

    system, base = _remote(folder)
    for e in system.get_file_info(FileSelector(base)):
        if e.type in (FileType.File, FileType.Directory):
            when = e.mtime.timestamp() if e.mtime else 0.0
            yield f"{folder.rstrip('/')}/{e.base_name}", e.base_name, e.size or 0, when, e.type == FileType.Directory


class _Folder(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, folders: list):
        self.folders = folders

    def partitions(self):
        return [_Folder(f) for f in self.folders]

    def read(self, partition):
        rows = []

        def batch():
            cols = list(zip(*rows)) or [()] * 5
            when = [datetime.datetime.fromtimestamp(t, datetime.timezone.utc) for t in cols[3]]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.bool_())
            values = (cols[0], cols[1], [0 if d else n for n, d in zip(cols[2], cols[4])], when, cols[4])
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)],
                                              ["path", "name", "length", "modificationTime", "is_dir"])

        for row in _entries(partition.path):
            rows.append(row)
            if len(rows) >= BATCH:
                yield batch()
                rows = []
        if rows:
            yield batch()


class FolderListing(DataSource):
    """``spark.read.format("folder_listing").option("paths", json list).load()`` or ``.load(path)``."""

    @classmethod
    def name(cls):
        return "folder_listing"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        paths = json.loads(self.options["paths"]) if "paths" in self.options else [self.options["path"]]
        return _Reader(paths)


def _reachable(path: str) -> bool:
    if local_path(path) is not None:
        return True
    try:
        _remote(path)
        return True
    except Exception:  # no such store in pyarrow, or its library is missing
        return False


def _by_hadoop(spark: SparkSession, path: str) -> DataFrame:
    """The same rows from the listing of Spark's own file system, in batches of BATCH names."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    listing = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatusIterator(folder)
    out, rows = spark.createDataFrame([], SCHEMA), []

    def flush(out):
        part = (spark.createDataFrame(rows, "path string, name string, length long, ms long, is_dir boolean")
                .select("path", "name", "length", F.timestamp_millis("ms").alias("modificationTime"), "is_dir"))
        return out.unionByName(part)

    while listing.hasNext():
        f = listing.next()
        rows.append((f.getPath().toString(), f.getPath().getName(), 0 if f.isDirectory() else f.getLen(),
                     f.getModificationTime(), f.isDirectory()))
        if len(rows) >= BATCH:
            out, rows = flush(out), []
    return flush(out) if rows else out


def list_folder(spark: SparkSession, *paths: str) -> DataFrame:
    """Every entry directly in the folders: path, name, length (0 for directories),
    modificationTime, is_dir, hidden (a name that Spark's file sources skip)."""
    near = [p for p in paths if _reachable(p)]
    spark.dataSource.register(FolderListing)
    out = [spark.read.format("folder_listing").option("paths", json.dumps(near)).load()] if near else []
    out += [_by_hadoop(spark, p) for p in paths if p not in near]
    df = out[0]
    for more in out[1:]:
        df = df.unionByName(more)
    # Spark's rule: a name begins with a dot, or with an underscore and holds no "=", or is a copy in progress
    name = F.col("name")
    hidden = (name.startswith(".") | (name.startswith("_") & ~name.contains("=")) | name.endswith("._COPYING_"))
    return df.withColumn("hidden", hidden)


def glob_regex(glob: str) -> str:
    """A Hadoop file glob (``*``, ``?``, ``[a-z]``, ``{a,b}``) as a regular expression of names."""
    out, depth = [], 0
    for c in re.findall(r"\\.|\[[^\]]*\]|.", glob, re.S):
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "{":
            depth += 1
            out.append("(?:")
        elif c == "}" and depth:
            depth -= 1
            out.append(")")
        elif c == "," and depth:
            out.append("|")
        elif c[0] == "[" and len(c) > 1:
            out.append("[^" + c[2:] if c[1] in "!^" else c)
        else:
            out.append(re.escape(c[-1]))
    return "(?s)^" + "".join(out) + "$"


def _open(path: str):
    here = local_path(path)
    if here is None:
        system, base = _remote(path)
        return system.open_input_file(base)
    # a listed local path is as on disk, not escaped
    return open(path[5:] if path.startswith("file:") else path, "rb")


def _owned(f, start: int, end: int, length: int) -> bytes:
    """The lines that begin in [start, end) of a file, up to and with their \\n."""
    def line_end(at: int) -> int:
        while at < length:
            f.seek(at)
            part = f.read(1 << 16)
            if not part:
                return at
            k = part.find(b"\n")
            if k >= 0:
                return at + k + 1
            at += len(part)
        return length

    first = line_end(start - 1) if start else 0
    if first >= end:
        return b""
    stop = line_end(end - 1)
    f.seek(first)
    return f.read(stop - first)


def file_pieces(files: DataFrame, piece_bytes: int) -> DataFrame:
    """path, start, content: the bytes of ``files`` (path, length) in pieces of whole lines, each
    near ``piece_bytes`` long; a file up to that size is one piece. An empty piece has no
    row unless it is a whole empty file. Pieces are read in parallel, TASK_FILES a task."""
    size, zero = F.lit(piece_bytes).cast("long"), F.lit(0).cast("long")
    ranges = files.select("path", "length", F.explode(F.sequence(zero, F.greatest(F.col("length") - 1, zero), size)).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + size, F.col("length")).alias("end"), "length")

    def run(batches):
        for b in batches:
            names, starts, blobs, held = [], [], [], 0
            for path, start, end, length in zip(*(b.column(i).to_pylist() for i in range(4))):
                if length:
                    with _open(path) as f:
                        blob = f.read() if end - start == length else _owned(f, start, end, length)
                if not length or blob:
                    names.append(path), starts.append(start), blobs.append(blob if length else b"")
                    held += len(blobs[-1])
                if held >= READ_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(starts, pa.int64()), pa.array(blobs, pa.binary())],
                                                     ["path", "start", "content"])
                    names, starts, blobs, held = [], [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(starts, pa.int64()), pa.array(blobs, pa.binary())],
                                             ["path", "start", "content"])

    n = ranges.count()
    if n > TASK_FILES:
        ranges = ranges.repartition(-(-n // TASK_FILES), F.xxhash64("path", "start"))
    return ranges.mapInArrow(run, "path string, start long, content binary")


def _by_value():
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_by_value()
