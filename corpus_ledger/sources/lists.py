"""Identifier lists: one identifier per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip


def exists(spark: SparkSession, path: str) -> bool:
    """Does the path, or a file the pattern names, exist in its store?"""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jvm_path)
    return found is not None and len(found) > 0


def read_identifiers(spark: SparkSession, *paths: str, comments: bool = False) -> DataFrame:
    """``(identifier, path, pos)`` of non-blank lines, repeats kept.

    All files are one scan, and ``pos`` grows along each file. With ``comments`` lines that start with ``#`` are left
    out. A missing file is skipped.
    """
    there = [p for p in paths if exists(spark, p)]
    if not there:
        return spark.createDataFrame([], "identifier string, path string, pos bigint")
    rows = (
        spark.read.text(there)
        .select(
            strip(F.col("value")).alias("identifier"), F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"),
        )
        .filter("identifier <> ''")
    )
    if comments:
        rows = rows.filter(~F.col("identifier").startswith("#"))
    # Rows of a task are numbered upwards, fewer than it has bytes; the split start orders the splits of one file.
    place = F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.select("identifier", "path", place.alias("pos"))


def read_identifier_set(spark: SparkSession, *paths: str, comments: bool = False) -> DataFrame:
    """Distinct identifiers of one or more lists, as ``doi``."""
    rows = read_identifiers(spark, *paths, comments=comments)
    return rows.select(F.col("identifier").alias("doi")).distinct()
