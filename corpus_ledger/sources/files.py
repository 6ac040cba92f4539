"""Files as rows: listings, parts of files by ranged reads, one file per row, and a stream of file revisions.

Spark's readers list a folder on the driver, keep a status of each file there and plan a task for a few dozen small files. The
sources here are for folders of millions of small files: a folder is listed as a stream of names, tasks look at the files, and
the driver holds nothing per file. They also read the two ends of a file and nothing between, write a file of its own for
each row with all or none of them in place, and see a file again when it is rewritten. Paths are those of file systems
pyarrow opens (local, hdfs, s3, gs).
"""

from __future__ import annotations

import os
import posixpath
import time
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from fnmatch import fnmatchcase
from itertools import islice

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Names listed, and files looked at, at a time.
NAMES_AT_ONCE = 4096
FILES_AT_ONCE = 256
#: File contents a task holds at a time, but for a single larger file.
BYTES_AT_ONCE = 8 << 20
#: Tasks for the files of a listing, and for the files of a write, per core.
TASKS_PER_CORE = 4


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """File system of a path, and the path as that file system names it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def is_local(path: str) -> bool:
    return isinstance(opened(path)[0], pafs.LocalFileSystem)


def names_in(path: str, pattern: str = "*", any_case: bool = True) -> Iterator[str]:
    """Names of the files right below a folder that match, in no order; none if there is no folder.

    A local folder is read as a stream. Other file systems hand their listing over as a whole.
    """
    fs, folder = opened(path)
    wanted = pattern.lower() if any_case else pattern

    def matches(name: str) -> bool:
        return not name.startswith(("_", ".")) and fnmatchcase(name.lower() if any_case else name, wanted)

    if not isinstance(fs, pafs.LocalFileSystem):
        infos = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        yield from (i.base_name for i in infos if i.type == pafs.FileType.File and matches(i.base_name))
    elif os.path.isdir(folder):
        with os.scandir(folder) as entries:
            yield from (e.name for e in entries if matches(e.name) and e.is_file())


def in_chunks(items: Iterator, size: int) -> Iterator[list]:
    items = iter(items)
    while chunk := list(islice(items, size)):
        yield chunk


def infos_of(fs: pafs.FileSystem, folder: str, names: list[str]) -> list[pafs.FileInfo]:
    """Size and time of files of a folder; those that went meanwhile are left out."""
    folder = folder.rstrip("/")
    return [i for i in fs.get_file_info([f"{folder}/{n}" for n in names]) if i.type == pafs.FileType.File]


def _millis(info: pafs.FileInfo) -> int:
    return info.mtime_ns // 1_000_000


def _utc(millis: int) -> datetime:
    return datetime.fromtimestamp(millis / 1000, timezone.utc)


def _tasks(spark: SparkSession) -> int:
    return TASKS_PER_CORE * spark.sparkContext.defaultParallelism


# -- the files of folders ----------------------------------------------------------------

INFO = "path string, dir string, name string, length bigint, modificationTime timestamp"
INFO_KINDS = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.timestamp("us", "UTC"))


def _per_file(
    spark: SparkSession, folders: Sequence[str], pattern: str, any_case: bool, more: str = "", kinds: tuple = (),
    look: Callable[[pafs.FileSystem, pafs.FileInfo], tuple[tuple, int]] | None = None,
) -> DataFrame:
    """One row per file right below some folders: what its status says and what ``look`` adds (with the bytes that holds).

    A task per folder lists the names, as a stream; they are dealt to tasks that look at the files. No content passes a shuffle.
    """
    folders = list(folders)

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                for chunk in in_chunks(names_in(folders[k], pattern, any_case), NAMES_AT_ONCE):
                    yield pa.RecordBatch.from_arrays([pa.array([k] * len(chunk), pa.int32()), pa.array(chunk, pa.string())], names=["folder", "name"])

    columns = [c.split()[0] for c in f"{INFO}{more}".split(", ")]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (*INFO_KINDS, *kinds))], names=columns)

        places = [opened(f) for f in folders]
        for batch in batches:
            for chunk in in_chunks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), FILES_AT_ONCE):
                rows, size = [], 0
                for k, (fs, folder) in enumerate(places):
                    own = [name for at, name in chunk if at == k]
                    for info in infos_of(fs, folder, own) if own else ():
                        added, n = look(fs, info) if look else ((), 0)
                        rows.append((info.path, posixpath.basename(posixpath.dirname(info.path)), info.base_name, info.size, _utc(_millis(info)), *added))
                        size += n
                        if size >= BYTES_AT_ONCE:
                            yield out(rows)
                            rows, size = [], 0
                if rows:
                    yield out(rows)

    listed = spark.range(0, len(folders), 1, max(1, len(folders))).mapInArrow(names, "folder int, name string")
    return listed.repartition(_tasks(spark), "folder", "name").mapInArrow(rows_of, f"{INFO}{more}")


def file_infos(spark: SparkSession, *folders: str, pattern: str = "*", any_case: bool = True) -> DataFrame:
    """Path, folder name, name, size and time of the files right below some folders."""
    return _per_file(spark, folders, pattern, any_case)


def file_contents(spark: SparkSession, *folders: str, pattern: str = "*", any_case: bool = True) -> DataFrame:
    """The files right below some folders with their ``content``."""

    def look(fs: pafs.FileSystem, info: pafs.FileInfo) -> tuple[tuple, int]:
        with fs.open_input_file(info.path) as f:
            content = f.read()
        return (content,), len(content)

    return _per_file(spark, folders, pattern, any_case, ", content binary", (pa.binary(),), look)


def file_edges(spark: SparkSession, *folders: str, pattern: str = "*", head: int = 5, tail: int = 1024, min_length: int = 0) -> DataFrame:
    """Path, name, size, time and both ends of the files right below some folders, by ranged reads.

    Files shorter than ``min_length`` are not opened: their ends are NULL. Upper and lower case of names match alike.
    """

    def look(fs: pafs.FileSystem, info: pafs.FileInfo) -> tuple[tuple, int]:
        if info.size < min_length:
            return (None, None, 0), 0
        first, last = min(head, info.size), min(tail, info.size)
        if not first + last:
            return (b"", b"", 0), 0
        with fs.open_input_file(info.path) as f:
            ends = f.read_at(first, 0), f.read_at(last, info.size - last)
        n = len(ends[0]) + len(ends[1])
        return (*ends, n), n

    return _per_file(spark, folders, pattern, True, ", head binary, tail binary, bytes_read bigint", (pa.binary(), pa.binary(), pa.int64()), look)


# -- one file per row --------------------------------------------------------------------


def write_files(df: DataFrame, path: str, name: str = "name", body: str = "body", mode: str = "append") -> None:
    """A file for each row of ``df`` below ``path``: all of them, or none if the job fails.

    Tasks write to folders of their own below a hidden staging folder and note the names in a table there. Only when all
    are done, no name occurs twice and, unless the mode is ``overwrite``, none is there already, tasks move the
    files into place; a move that runs again finds its file there. The driver holds no names. A task that is killed
    while the job ends can leave its hidden staging folder.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    fs, folder = opened(path)
    hidden = f"_staging-{uuid.uuid4().hex}"
    staging = f"{folder.rstrip('/')}/{hidden}"
    new = fs.get_file_info(folder).type == pafs.FileType.NotFound
    fs.create_dir(staging)
    rows = df.selectExpr(f"CAST({name} AS string) AS name", f"CAST({body} AS binary) AS body")
    try:
        rows.mapInArrow(_staged(path, hidden), "name string, place string").write.parquet(f"{path.rstrip('/')}/{hidden}/_names")
        names = spark.read.schema("name string, place string").parquet(f"{path.rstrip('/')}/{hidden}/_names")
        twice = names.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").first()
        if twice:
            raise ValueError(f"a name occurs twice: {twice['name']!r}")
        spread = names.repartition(_tasks(spark), "name")
        if not new and mode == "append":
            there = [r["name"] for r in spread.select("name").mapInArrow(_there(path), "name string").limit(3).collect()]
            if there:
                raise ValueError(f"files are there already: {sorted(there)}")
        spread.mapInArrow(_moved(path, hidden), "n bigint").write.format("noop").mode("overwrite").save()
    finally:
        fs.delete_dir(staging)


def _staged(path: str, hidden: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write the bodies of rows to files of a new folder below the staging folder; the names, and that folder."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = opened(path)
        place = uuid.uuid4().hex
        own = f"{folder.rstrip('/')}/{hidden}/{place}"
        fs.create_dir(own)
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not name or "/" in name or name.startswith(("_", ".")):
                    raise ValueError(f"not a file name: {name!r}")
                with fs.open_output_stream(f"{own}/{name}") as out:
                    if body.is_valid:
                        out.write(body.as_buffer())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([place] * batch.num_rows, pa.string())], names=["name", "place"])

    return work


def _there(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of names, those of files in a folder."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = opened(path)
        for batch in batches:
            for chunk in in_chunks(batch.column(0).to_pylist(), FILES_AT_ONCE):
                found = [i.base_name for i in infos_of(fs, folder, chunk)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["name"])

    return work


def _moved(path: str, hidden: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Move staged files into place; those an earlier attempt of the task has moved are there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = opened(path)
        folder = folder.rstrip("/")
        for batch in batches:
            for name, place in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    fs.move(f"{folder}/{hidden}/{place}/{name}", f"{folder}/{name}")
                except FileNotFoundError:
                    if fs.get_file_info(f"{folder}/{name}").type != pafs.FileType.File:
                        raise
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return work


# -- a stream of revisions ---------------------------------------------------------------

REVISIONS = "path string, name string, length bigint, modificationTime timestamp"


@dataclass
class Share(InputPartition):
    """The files of one task: those whose names' checksums leave ``part`` of ``parts``, written after one time and up to another."""

    part: int
    parts: int
    after: int
    until: int


class FileRevisions(DataSource):
    """``file_revisions``: a stream with a row for each file each time it is written.

    A revision is a path and its time of writing. The offset is a time in milliseconds: a batch holds the revisions
    after the last offset up to one that is ``settleMs`` old, so none counts twice, and a file that lands while a
    folder is listed comes with a later batch. The offset moves on when there is a new revision; the driver looks for one and
    holds no list. Tasks list the folder themselves and look at the files of their share (on file systems other than
    the local one a single task does).
    """

    @classmethod
    def name(cls) -> str:
        return "file_revisions"

    def schema(self) -> str:
        return REVISIONS

    def streamReader(self, schema) -> DataSourceStreamReader:
        return RevisionReader(self.options)


class RevisionReader(DataSourceStreamReader):
    def __init__(self, options):
        self.folder, self.pattern = options["path"], options.get("pattern", "*")
        self.settle = int(options.get("settlems", 1000))
        self.parts = int(options.get("parts", 1)) if is_local(self.folder) else 1
        self.last = -1

    def initialOffset(self) -> dict:
        return {"after": -1}

    def latestOffset(self) -> dict:
        until = int(time.time() * 1000) - self.settle
        new = any(True for _ in self._revisions(0, 1, self.last, until))
        return {"after": until if new else self.last}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.last = max(self.last, end["after"])
        return [Share(k, self.parts, start["after"], end["after"]) for k in range(self.parts)]

    def _revisions(self, part: int, parts: int, after: int, until: int) -> Iterator[pafs.FileInfo]:
        fs, folder = opened(self.folder)
        own = (n for n in names_in(self.folder, self.pattern) if parts == 1 or zlib.crc32(os.fsencode(n)) % parts == part)
        for chunk in in_chunks(own, FILES_AT_ONCE):
            yield from (i for i in infos_of(fs, folder, chunk) if after < _millis(i) <= until)

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.string(), pa.int64(), pa.timestamp("us", "UTC"))
        for chunk in in_chunks(self._revisions(partition.part, partition.parts, partition.after, partition.until), NAMES_AT_ONCE):
            rows = zip(*[(i.path, i.base_name, i.size, _utc(_millis(i))) for i in chunk])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)], names=["path", "name", "length", "modificationTime"])


def file_revisions(spark: SparkSession, folder: str, pattern: str = "*", settle_ms: int = 1000) -> DataFrame:
    """Stream of file revisions below a folder (path, name, size, time); rewritten files come again."""
    spark.dataSource.register(FileRevisions)
    reader = spark.readStream.format("file_revisions").option("pattern", pattern).option("settleMs", settle_ms)
    return reader.option("parts", spark.sparkContext.defaultParallelism).load(folder)
