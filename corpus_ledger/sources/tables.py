"""Keyed tables: papers, evaluations, ledger snapshots and tracker files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import has_text_sql


def _with_status(df: DataFrame) -> DataFrame:
    # added on demand by older tables' owners
    return df if "parsing_status" in df.columns else df.withColumn("parsing_status", F.lit(None).cast("string"))


def read_papers(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Paper table (parquet), some of its columns or all; Spark reads no others."""
    df = _with_status(spark.read.parquet(path))
    return df.select(*columns) if columns else df


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = "doi") -> DataFrame:
    """A table of one sorted file per bucket of the key, read back.

    Tables with the same number of buckets meet on their key without a shuffle, and a filter on a key reads its
    bucket only. One key has one row here; a table in which a key repeats a lot is better left unbucketed.
    """
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("errorifexists").saveAsTable(table)
    return df.sparkSession.table(table)


def read_keyed(table: DataFrame, keys: list[str], columns: list[str] | None = None, key: str = "doi") -> DataFrame:
    """Rows of a few keys. The filter reaches the scan, which opens only the buckets that can hold them."""
    rows = table.filter(F.col(key).isin(*keys) if keys else F.lit(False))
    return rows.select(*columns) if columns else rows


def read_evaluations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("doi", "result", F.col("confidence_score").cast("double"))


def read_tracker_file(spark: SparkSession, *paths: str, version: int = 1) -> DataFrame:
    """Tracker CSV files of one version (11 or 15 columns); empty cells stay empty strings."""
    schema = schemas.TRACKER_FILE_V1 if version == 1 else schemas.TRACKER_FILE_V2
    rows = spark.read.csv(list(paths), header=True, schema=schema, quote='"', escape='"')
    return rows.na.fill("")


def union_tracker_files(*frames: DataFrame) -> DataFrame:
    """Rows of several file versions in one frame; columns a version lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def status_of(ledger: DataFrame, doi: str) -> DataFrame:
    """One key's row (interactive use; jobs join)."""
    return ledger.filter(has_text_sql(F.col("doi")) & (F.col("doi") == F.lit(doi)))
