"""Status distributions, run reports and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import null_if_empty
from ..schemas import SUCCESS

# Result states shown in a run summary.
RUN_STATES = {
    "success": "success",
    "skipped_complete": "skipped_complete",
    "skipped_failed": "skipped_failed",
    "not_found": "not_found",
    "processing_failed": "failed",
}
RETRY_STATE = "not_found"


def status_distribution(papers: DataFrame) -> DataFrame:
    """Papers per status, most frequent first; NULL and empty stay apart but show alike."""
    return (
        papers.groupBy("parsing_status")
        .agg(F.count(F.lit(1)).alias("papers"))
        .select("parsing_status", F.coalesce(null_if_empty(F.col("parsing_status")), F.lit("NULL/Empty")).alias("shown_as"), "papers")
        .orderBy(F.desc("papers"), F.asc_nulls_first("parsing_status"))
    )


def run_summary(results: DataFrame) -> DataFrame:
    """One row: total and the five run states."""
    return results.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("status") == s).alias(name) for s, name in RUN_STATES.items()],
    )


def run_report(results: DataFrame) -> DataFrame:
    """Count and share per status. The window runs over the grouped rows, one per status."""
    counts = results.groupBy("status").agg(F.count(F.lit(1)).alias("papers"))
    whole = F.sum("papers").over(Window.partitionBy())
    return counts.withColumn("pct", F.round(F.col("papers") * 100.0 / whole, 2))


def retry_list(results: DataFrame) -> DataFrame:
    return results.filter(F.col("status") == RETRY_STATE).select("identifier")


def failed_files(results: DataFrame) -> DataFrame:
    return results.filter(F.col("status") != SUCCESS).select("identifier", "status")


def timing_by_mode(results: DataFrame) -> DataFrame:
    """Successful papers and mean seconds per mode."""
    ok = F.col("status") == SUCCESS
    return results.groupBy("mode").agg(
        F.count(F.lit(1)).alias("papers"), F.count_if(ok).alias("successful"),
        F.round(F.avg(F.when(ok, F.col("seconds"))), 4).alias("avg_seconds"),
    )


def first_keys(rows: DataFrame, kind: str, n: int) -> DataFrame:
    """The first ``n`` DOIs of each kind in sorted order.

    Spark limits each task to ``n`` rows per kind before the shuffle, so a kind with most
    of the rows does not gather in one task.
    """
    rank = F.row_number().over(Window.partitionBy(kind).orderBy("doi"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= n).select(kind, "rank", "doi")
