"""What to do next with each identifier, and which source or file wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import normalize_doi, stem_of
from ..functions.text import is_value, spread_key
from ..schemas import FAILED, NO, SUCCESS, TRACKED_SOURCES, YES

# Order in which sources are tried.
SOURCE_ORDER = [
    "oa_sciencedirect",
    "oa_direct",
    "openalex_sciencedirect",
    "openalex",
    "arxiv",
    "biorxiv",
    "europepmc",
    "unpaywall",
    "semanticscholar",
    "doi_sciencedirect",
    "doi_content_neg",
]
# Retries after which an exhausted or unparsable paper is left alone.
MAX_EXHAUSTED_RETRIES = 1
MAX_PARSER_RETRIES = 2
STATUS_COLUMN = {"fast": "pymupdf_status", "grobid": "grobid_status"}
FILE_COLUMN = {"fast": "has_pymupdf", "grobid": "has_grobid"}


def exhausted() -> Column:
    """Every source was tried and none delivered. Comparisons with NULL are false."""
    tried = is_value(F.col("downloaded"), NO)
    for source in ("scihub", "oa"):
        tried = tried & (is_value(F.col(f"{source}_available"), NO) | is_value(F.col(f"{source}_downloaded"), NO))
    for source in TRACKED_SOURCES:
        tried = tried & is_value(F.col(f"{source}_attempted"), YES)
    return tried


def partition_work(
    identifiers: DataFrame,
    ledger: DataFrame,
    files: DataFrame,
    parser: str = "fast",
    max_exhausted: int = MAX_EXHAUSTED_RETRIES,
    max_parser: int = MAX_PARSER_RETRIES,
) -> DataFrame:
    """Bucket of every listed identifier: needs_download, needs_parse_only, complete, skipped_failed.

    ``identifiers(identifier)`` may repeat; repeats are counted into ``n_listed`` before
    any join, so a list that is one identifier a million times is one row. ``files`` is
    :func:`inventory.presence_by_stem`. The ledger is looked up by the raw identifier,
    the files by the normalised one.
    """
    listed = identifiers.groupBy("identifier").agg(F.count(F.lit(1)).alias("n_listed"))
    held = ledger.select(
        F.col("doi").alias("identifier"), F.lit(True).alias("_tracked"), exhausted().alias("_exhausted"),
        F.col(STATUS_COLUMN[parser]).alias("_status"), is_value(F.col("downloaded"), YES).alias("_downloaded"),
        F.coalesce(F.col("retry_count").cast("int"), F.lit(0)).alias("_retries"),
    )
    found = files.select("stem", F.col("has_pdf").alias("_pdf"), F.col(FILE_COLUMN[parser]).alias("_json"))
    joined = (
        listed.join(held, "identifier", "left")
        .withColumn("doi", normalize_doi(F.col("identifier")))
        .withColumn("stem", stem_of(spread_key(F.col("doi"), F.col("identifier"))))
        .join(found, "stem", "left")
    )
    pdf, json = (F.coalesce(F.col(c), F.lit(False)) for c in ("_pdf", "_json"))
    bucket = (
        F.when(F.col("_exhausted") & (F.col("_retries") >= max_exhausted), "skipped_failed")
        .when(F.col("_status") == SUCCESS, "complete")
        .when((F.col("_status") == FAILED) & (F.col("_retries") >= max_parser), "skipped_failed")
        .when(F.col("_downloaded"), F.when(pdf, "needs_parse_only").otherwise("needs_download"))
        .when(F.col("doi").isNull() | ~pdf, "needs_download")
        .when(~json, "needs_parse_only")
        .otherwise("complete")
    )
    return joined.select("identifier", "doi", "n_listed", bucket.alias("bucket"))


def partition_sizes(plan: DataFrame) -> DataFrame:
    return plan.groupBy("bucket").agg(F.count(F.lit(1)).alias("identifiers"), F.sum("n_listed").alias("listed"))


def _rank(source: Column) -> Column:
    """Place of a source in the order, NULL for one that is not in it."""
    return F.nullif(F.array_position(F.array(*[F.lit(s) for s in SOURCE_ORDER]), source), F.lit(0))


def waterfall(attempts: DataFrame) -> DataFrame:
    """First source in order that delivered, and the ledger columns its attempts imply.

    ``attempts(doi, source, ok)``. Attempts behind the winner never took place. Each
    source is reduced to two flags per DOI by a grouping, whatever the number of attempts.
    """
    rank = _rank(F.col("source"))
    ranked = attempts.withColumn("_rank", rank).filter("_rank IS NOT NULL")
    per_doi = ranked.groupBy("doi").agg(
        F.min(F.when(F.col("ok"), F.col("_rank"))).alias("win_rank"),
        *[F.max(F.when(F.col("source") == s, F.col("ok"))).alias(f"_{s}") for s in TRACKED_SOURCES],
    )
    place = {s: SOURCE_ORDER.index(s) + 1 for s in TRACKED_SOURCES}

    def reached(s: str) -> Column:
        return F.col(f"_{s}").isNotNull() & (F.col("win_rank").isNull() | (F.col("win_rank") >= place[s]))

    winner = F.get(F.array(*[F.lit(s) for s in SOURCE_ORDER]), (F.col("win_rank") - 1).cast("int"))
    columns = []
    for s in TRACKED_SOURCES:
        columns.append(F.when(reached(s), YES).alias(f"{s}_attempted"))
        columns.append(F.when(reached(s), F.when(F.col(f"_{s}"), YES).otherwise(NO)).alias(f"{s}_downloaded"))
    return per_doi.select(
        "doi", winner.alias("source"), F.col("win_rank").isNotNull().alias("found"), *columns,
        F.when(F.col("win_rank").isNotNull(), YES).otherwise(NO).alias("oa_available"),
    )


def resolve_downloads(work: DataFrame, primary: DataFrame, fallback: DataFrame, manual: DataFrame) -> DataFrame:
    """Outer waterfall: primary source, then the open sources, then a file dropped in by hand.

    ``primary(doi, ok)``, ``fallback`` from :func:`waterfall`, ``manual(doi)``.
    """
    first = primary.groupBy("doi").agg(F.max("ok").alias("_primary"))
    second = fallback.select("doi", F.col("source").alias("_source"), F.col("found").alias("_found"))
    by_hand = manual.select("doi").distinct().withColumn("_manual", F.lit(True))
    joined = (
        work.select("doi").distinct().join(first, "doi", "left").join(second, "doi", "left").join(by_hand, "doi", "left")
    )
    how = (
        F.when(F.col("_primary"), "primary").when(F.col("_found"), F.col("_source")).when(F.col("_manual"), "manual")
    )
    return joined.select("doi", how.alias("download_source")).withColumns(
        {
            "download_status": F.when(F.col("download_source").isNull(), FAILED)
            .when(F.col("download_source") == "manual", "manual")
            .otherwise(SUCCESS),
            "retry_step": F.col("download_source").isNull().cast("int"),
        }
    )


def run_results(plan: DataFrame, downloads: DataFrame, parses: DataFrame, parser: str = "fast") -> DataFrame:
    """Result row per listed identifier: status, download_status, parsing_status.

    ``parses(doi, outcome)`` holds success, failed or error for what was parsed.
    """
    got = downloads.select("doi", F.col("download_status").alias("_download"))
    done = parses.select("doi", F.col("outcome").alias("_parse"))
    rows = plan.withColumn("_key", spread_key(F.col("doi"), F.col("identifier")))
    joined = (
        rows.join(got.withColumnRenamed("doi", "_key"), "_key", "left").join(done.withColumnRenamed("doi", "_key"), "_key", "left")
    )
    bucket = F.col("bucket")
    invalid = (bucket == "needs_download") & F.col("doi").isNull()
    download = (
        F.when(bucket == "complete", "skipped_exists")
        .when(bucket == "skipped_failed", "skipped_unavailable")
        .when(bucket == "needs_parse_only", "skipped_exists")
        .when(invalid, "skipped")
        .otherwise(F.coalesce("_download", F.lit(FAILED)))
    )
    parsed = (
        F.when(bucket == "complete", "skipped_exists")
        .when(bucket == "skipped_failed", "skipped_failed")
        .when(invalid, "skipped")
        .when((bucket == "needs_download") & ~F.coalesce(F.col("_download").isin(SUCCESS, "manual"), F.lit(False)), F.lit(None).cast("string"))
        .otherwise(F.coalesce("_parse", F.lit(FAILED)))
    )
    status = (
        F.when(bucket == "complete", "skipped_complete")
        .when(bucket == "skipped_failed", "skipped_failed")
        .when(invalid, "invalid_identifier")
        .when(F.col("parsing_status").isNull(), "not_found")
        .when(F.col("parsing_status") == SUCCESS, SUCCESS)
        .otherwise("processing_failed")
    )
    return joined.select(
        "identifier", "doi", "n_listed", "bucket", download.alias("download_status"), parsed.alias("parsing_status"), F.lit(parser).alias("parser_used")
    ).withColumn("status", status)


def update_run_status(
    downloaded: Column, processed: Column, updated: Column, failed_error: Column
) -> Column:
    """Status of the one-step fetch-and-store run."""
    return (
        F.when(failed_error.isNotNull(), "error")
        .when(~downloaded, "failed_download")
        .when(~processed, "failed_processing")
        .when(~updated, "failed_update")
        .otherwise(SUCCESS)
    )
