"""Files of extracted documents and PDFs. Names carry the DOI stem and the parser."""

from __future__ import annotations

import time

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import validity as VA
from ..functions.identifiers import FAST_SUFFIX
from . import files, sinks

INVENTORY = ["stem", "dir", "parser", "length", "modificationTime"]


def _name_columns(path: Column) -> dict[str, Column]:
    name = F.substring_index(path, "/", -1)
    base = F.regexp_replace(name, r"(?i)\.(json|pdf)$", "")
    is_json = F.lower(name).endswith(".json")
    return {
        "stem": F.when(is_json, F.regexp_replace(base, f"{FAST_SUFFIX}$", "")).otherwise(base),
        "dir": F.element_at(F.split(path, "/"), -2),
        "parser": F.when(is_json, F.when(base.endswith(FAST_SUFFIX), "pymupdf").otherwise("grobid")),
    }


def _present(folders: tuple[str, ...]) -> None:
    for folder in folders:
        fs, own = files.opened(folder)
        if fs.get_file_info(own).type == pafs.FileType.NotFound:
            raise FileNotFoundError(f"no folder {folder}")


def list_extractions(spark: SparkSession, folder: str) -> DataFrame:
    """Presence of extraction files that hold something. No file is opened."""
    _present((folder,))
    found = files.file_infos(spark, folder, pattern="*.json", any_case=False).filter("length > 0")
    return found.withColumns(_name_columns(F.col("path"))).select(INVENTORY)


def read_extractions(spark: SparkSession, folder: str) -> DataFrame:
    """Extraction files that hold something, with their text, one row per file."""
    _present((folder,))
    found = files.file_contents(spark, folder, pattern="*.json", any_case=False).filter("length > 0")
    return found.withColumns(_name_columns(F.col("path"))).select(*INVENTORY, F.col("content").cast("string").alias("body"))


def list_pdfs(spark: SparkSession, *folders: str) -> DataFrame:
    """Name, size and time of PDF files that hold something, whatever the case of the extension."""
    _present(folders)
    found = files.file_infos(spark, *folders, pattern="*.pdf").filter("length > 0")
    return found.withColumns(_name_columns(F.col("path"))).select(
        "stem", "dir", "length", "modificationTime", F.unix_seconds("modificationTime").alias("mtime_s")
    )


def checked_pdfs(spark: SparkSession, *folders: str) -> DataFrame:
    """PDF inventory with ``is_valid``. Of each file the head and the last 4 KB are read, of one below the least size nothing."""
    edges = files.file_edges(
        spark, *folders, pattern="*.pdf", head=VA.PDF_HEAD_BYTES, tail=VA.PDF_TAIL_BYTES, min_length=VA.PDF_MIN_BYTES
    )
    return edges.withColumns(_name_columns(F.col("path"))).select(
        "stem", "dir", "length", "modificationTime", "bytes_read", VA.is_valid_pdf_edges(F.col("length"), F.col("head"), F.col("tail")).alias("is_valid")
    )


def newer_than(files: DataFrame, stamp: Column) -> DataFrame:
    """Files changed after a stamp, out of a listing that is there."""
    return files.filter(F.col("modificationTime") > stamp)


class Scan:
    """Files of a folder that were written since the scan before, and the mark to keep once they are dealt with."""

    def __init__(self, spark: SparkSession, folder: str, marks: str, pattern: str = "*", settle_ms: int = 1000):
        self.spark, self.folder, self.marks, self.pattern = spark, folder, marks, pattern
        self.after = max(sinks.numbers_in(spark, marks), default=0)
        # Taken before the folder is listed: what lands from now on belongs to the next scan.
        self.before = max(self.after, int(time.time() * 1000) - settle_ms)

    def files(self) -> DataFrame:
        """Name columns, size and time of files that hold something; none is opened."""
        _present((self.folder,))
        found = files.file_infos(self.spark, self.folder, pattern=self.pattern, any_case=False).filter("length > 0")
        written = F.unix_millis("modificationTime")
        own = found.filter((written >= self.after) & (written < self.before))
        return own.withColumns(_name_columns(F.col("path"))).select(INVENTORY)

    def done(self) -> None:
        """Keep the mark: the next scan starts here."""
        sinks.noted(self.spark, f"{self.marks}/{self.before}", 1)
