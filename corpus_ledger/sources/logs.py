"""Run logs: text blocks between markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stages import once
from ..functions.text import null_if_empty, strip

# Block markers of the two log formats.
MARKER = "DOI/Identifier:"
RULE = "=" * 80


def _field(block: Column, pattern: str) -> Column:
    return null_if_empty(strip(F.regexp_extract(block, pattern, 1)))


def parse_blocks(blocks: DataFrame) -> DataFrame:
    """``(doi, ts, result, parser)`` of block texts; a block without all three fields is dropped.

    A block is the text between two markers, so a field of one block is never taken for
    another's.
    """
    block = F.col("block")
    # The result ends where its line ends, or where a parser label follows.
    result = r"(?s)Result:\s*([^\n]+?)(?=\s+Parser:|\n|$)"
    parser = r"(?s)Result:\s*[^\n]+?\s+Parser:\s*([^\n]+)"
    rest = [c for c in blocks.columns if c != "block"]
    fields = {
        "doi": _field(block, r"^\s*([^\n]+)\s+Timestamp:"),
        "ts": _field(block, r"^\s*[^\n]+\s+Timestamp:\s*([^\n]+)"),
        "result": _field(block, result),
        "parser": _field(block, parser),
    }
    return (
        once(blocks, fields)
        .filter("doi IS NOT NULL AND ts IS NOT NULL AND result IS NOT NULL")
        .select("doi", "ts", "result", "parser", *rest)
    )


def parse_current_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks of the current writer (``DOI:``, ``Status:``, ``Timestamp:`` lines); it names no parser."""
    block = F.col("block")
    rest = [c for c in blocks.columns if c != "block"]
    return (
        once(
            blocks,
            {
                "doi": _field(block, r"(?m)^DOI:[ \t]*([^\n]+)"),
                "ts": F.coalesce(_field(block, r"(?m)^Timestamp:[ \t]*([^\n]+)"), F.lit("")),
                "result": _field(block, r"(?m)^Status:[ \t]*([^\n]+)"),
                "parser": F.lit(None).cast("string"),
            },
        )
        .filter("doi IS NOT NULL AND result IS NOT NULL")
        .select("doi", "ts", "result", "parser", *rest)
    )


def read_blocks(spark: SparkSession, paths: list[str], separator: str = MARKER) -> DataFrame:
    """``(block, file_ord, pos)`` of log files, split at the marker by the reader itself.

    Using the marker as record separator lets Spark split one large log over many tasks.
    """
    frames = None
    for ord_, path in enumerate(paths):
        rows = spark.read.option("lineSep", separator).text(path)
        one = rows.select(
            F.col("value").alias("block"), F.lit(ord_).alias("file_ord"),
            # Splits are ordered by their start, rows of a split by their number.
            (F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).alias("pos"),
        )
        frames = one if frames is None else frames.unionByName(one)
    return frames


def read_logs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Entries of logs in the marker format."""
    return parse_blocks(read_blocks(spark, paths))


def read_current_logs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Entries of logs of the current writer, whose blocks a ruled line parts."""
    return parse_current_blocks(read_blocks(spark, paths, RULE))
