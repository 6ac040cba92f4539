"""Bring the ledger, the files and the paper table back in agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import validity as VA
from ..functions.identifiers import doi_of_stem, normalize_doi, stem_of
from ..functions.text import has_text_sql, is_value, spread_key
from ..schemas import FAILED, NO, NOT_ATTEMPTED, PARSERS, SUCCESS, YES
from .gaps import content_flags, key_union, keyed
from .inventory import with_doi

# Columns of the per-DOI summary kept beside the paper table.
STATE_LEDGER_COLUMNS = (
    "scihub_available",
    "scihub_downloaded",
    "oa_available",
    "oa_downloaded",
    "downloaded",
    "download_date",
    "pymupdf_status",
    "grobid_status",
)


def attempt_counts(events: DataFrame) -> DataFrame:
    """Attempts per DOI; downloads without a known source do not count."""
    kind, to = F.col("event_type"), F.col("status_to")
    return events.groupBy("doi").agg(
        F.count_if((kind == "download") & (to == "scihub")).alias("scihub_attempts"),
        F.count_if((kind == "download") & (to == "oa")).alias("oa_attempts"),
        F.count_if(kind == "pymupdf").alias("pymupdf_attempts"),
        F.count_if(kind == "grobid").alias("grobid_attempts"),
    )


def file_flags(extractions: DataFrame) -> DataFrame:
    return extractions.groupBy("stem").agg(*[F.max((F.col("parser") == p).cast("int")).alias(f"files_{p}") for p in PARSERS])


def processing_state(ledger: DataFrame, events: DataFrame, extractions: DataFrame) -> DataFrame:
    """Summary per tracked DOI: state, attempts, files, and whether files and state disagree."""
    joined = (
        ledger.join(attempt_counts(events), "doi", "left")
        .withColumn("stem", stem_of(F.col("doi")))
        .join(file_flags(extractions), "stem", "left")
    )
    counts = [f"{k}_attempts" for k in ("pymupdf", "grobid", "scihub", "oa")]
    files = {p: F.coalesce(F.col(f"files_{p}"), F.lit(0)) for p in PARSERS}
    disagree = [(files[p] == 1) != is_value(F.col(f"{p}_status"), SUCCESS) for p in PARSERS]
    return joined.select(
        "doi", *STATE_LEDGER_COLUMNS,
        *[F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c) for c in counts],
        *[c.alias(f"files_{p}") for p, c in files.items()],
        (disagree[0] | disagree[1]).cast("int").alias("mismatch_files_tracker"),
        "last_updated",
    )


def success_without_file(ledger: DataFrame, extractions: DataFrame) -> DataFrame:
    """``(doi, parser)`` marked as parsed whose output is gone."""
    claims = ledger.select(
        "doi",
        F.explode(
            F.filter(
                F.array(*[F.when(is_value(F.col(f"{p}_status"), SUCCESS), F.lit(p)) for p in PARSERS]), lambda p: p.isNotNull()
            )
        ).alias("parser"),
    ).withColumn("stem", stem_of(F.col("doi")))
    return claims.join(extractions.select("stem", "parser").distinct(), ["stem", "parser"], "left_anti").select("doi", "parser")


def reset_missing(ledger: DataFrame, extractions: DataFrame) -> DataFrame:
    """Ledger updates that set such states back; ``NULL`` leaves a column alone."""
    lost = success_without_file(ledger, extractions)
    gone = lost.groupBy("doi").agg(*[F.max(F.col("parser") == p).alias(p) for p in PARSERS])
    return gone.select("doi", *[F.when(F.col(p), NOT_ATTEMPTED).alias(f"{p}_status") for p in PARSERS])


def reset_missing_counts(ledger: DataFrame, extractions: DataFrame) -> DataFrame:
    return success_without_file(ledger, extractions).groupBy("parser").agg(F.count(F.lit(1)).alias("resets"))


def invalid_updates(bodies: DataFrame, ledger: DataFrame, at: Column) -> DataFrame:
    """Updates for extractions without content: failed at ``at``, with a reason and one more retry each.

    A DOI with two bad files gets both retries; the structured parser's message, applied
    last, stays. Only DOIs that are tracked have a retry count to raise.
    """
    bad = (
        VA.with_content_check(bodies)
        .filter("NOT is_valid OR NOT has_content")
        .select("stem", "parser", F.concat_ws(": ", "parser", "reason").alias("message"))
    )
    per_doi = with_doi(bad, ledger).groupBy("doi").agg(
        F.count(F.lit(1)).cast("int").alias("steps"),
        *[F.max(F.when(F.col("parser") == p, FAILED)).alias(f"{p}_status") for p in PARSERS],
        *[F.max(F.when(F.col("parser") == p, at.cast("timestamp"))).alias(f"{p}_date") for p in PARSERS],
        F.min_by("message", "parser").alias("error_msg"),
    )
    held = ledger.select("doi", F.coalesce(F.col("retry_count").cast("int"), F.lit(0)).alias("held"))
    retries = F.when(F.col("held").isNotNull(), F.col("held") + F.col("steps")).otherwise(F.col("steps") - 1)
    return per_doi.join(held, "doi", "left").select(
        "doi", *[f"{p}_{x}" for p in PARSERS for x in ("status", "date")], "error_msg", retries.alias("retry_count")
    )


def structured_scan(extractions: DataFrame, ledger: DataFrame) -> DataFrame:
    """Updates for structured outputs the ledger does not show as parsed."""
    done = ledger.filter(is_value(F.col("grobid_status"), SUCCESS)).select("doi")
    found = with_doi(extractions.filter(F.col("parser") == "grobid").select("stem").distinct(), ledger).select("doi").distinct()
    return found.join(done, "doi", "left_anti").select(
        "doi", F.lit(YES).alias("downloaded"), F.lit(YES).alias("scihub_available"), F.lit(SUCCESS).alias("grobid_status")
    )


def seeds_from_papers(papers: DataFrame, ledger: DataFrame) -> DataFrame:
    return keyed(papers).select("doi").distinct().join(ledger.select("doi"), "doi", "left_anti")


def seeds_from_files(extractions: DataFrame, pdfs: DataFrame, ledger: DataFrame) -> DataFrame:
    """DOIs seen only on disk; a PDF implies a finished download."""
    seen = (
        extractions.select("stem", F.lit(False).alias("pdf"))
        .unionByName(pdfs.select("stem", F.lit(True).alias("pdf")))
        .groupBy("stem")
        .agg(F.max("pdf").alias("pdf"))
    )
    rows = with_doi(seen, ledger).select("doi", F.when(F.col("pdf"), YES).alias("downloaded"))
    return rows.join(ledger.select("doi"), "doi", "left_anti")


def rebuild(papers: DataFrame, extractions: DataFrame, pdfs: DataFrame, at: Column) -> DataFrame:
    """Ledger and summary from scratch out of papers, extractions and two PDF folders.

    Files are reduced to one row per stem by a tagged union; papers are joined by the stem
    of their own DOI, and only files no paper claims have their DOI read back from the stem.
    """
    tags = extractions.select("stem", F.col("parser").alias("kind")).unionByName(
        pdfs.select("stem", F.when(F.col("dir") == "papers", "primary").otherwise("oa").alias("kind"))
    )
    kinds = (*PARSERS, "primary", "oa")
    files = tags.groupBy("stem").agg(*[F.max(F.col("kind") == k).alias(k) for k in kinds])
    known = (
        content_flags(keyed(papers)).groupBy("doi").agg(F.max("has_any").alias("has_any")).withColumn("stem", stem_of(F.col("doi")))
    )
    claimed = known.join(files, "stem", "left").select("doi", "has_any", *kinds)
    orphans = files.join(known.select("stem"), "stem", "left_anti").select(
        doi_of_stem(F.col("stem")).alias("doi"), F.lit(False).alias("has_any"), *kinds
    )
    rows = claimed.unionByName(orphans)

    def mark(cond: Column, value: str) -> Column:
        return F.when(F.coalesce(cond, F.lit(False)), value)

    any_pdf = F.coalesce(F.col("primary"), F.lit(False)) | F.coalesce(F.col("oa"), F.lit(False))
    when = at.cast("timestamp")
    return rows.select(
        "doi",
        mark(F.col("primary"), YES).alias("scihub_available"), mark(F.col("primary"), YES).alias("scihub_downloaded"),
        mark(F.col("oa"), YES).alias("oa_available"), mark(F.col("oa"), YES).alias("oa_downloaded"),
        mark(any_pdf, YES).alias("downloaded"), F.when(any_pdf, when).alias("download_date"),
        F.when(F.col("has_any"), YES).otherwise(NO).alias("has_content_in_db"),
        *[
            col
            for p in PARSERS
            for col in (mark(F.col(p), SUCCESS).alias(f"{p}_status"), F.when(F.col(p), when).alias(f"{p}_date"))
        ],
        *[F.coalesce(F.col(k).cast("int"), F.lit(0)).alias(f"{n}_attempts") for k, n in (("pymupdf", "pymupdf"), ("grobid", "grobid"), ("primary", "scihub"), ("oa", "oa"))],
        *[F.coalesce(F.col(p).cast("int"), F.lit(0)).alias(f"files_{p}") for p in PARSERS],
        F.lit(0).alias("mismatch_files_tracker"), F.lit(0).alias("retry_count"), when.alias("last_updated"),
    )


def enrich(papers: DataFrame, ledger: DataFrame, extractions: DataFrame) -> DataFrame:
    """Papers with their ledger state, files and URL flag, and defaults where nothing is known."""
    held = ledger.select(
        "doi", "scihub_available", "downloaded", *[F.col(f"{p}_status").alias(f"_{p}") for p in PARSERS],
        F.col("retry_count").cast("string").alias("retry_count"),
    )
    facts = content_flags(keyed(papers)).groupBy("doi").agg(F.max("has_content").alias("c"), F.max("has_oa_url").alias("u"))
    joined = (
        facts.join(held, "doi", "left").withColumn("stem", stem_of(F.col("doi"))).join(file_flags(extractions), "stem", "left")
    )
    return joined.select(
        "doi",
        F.coalesce("scihub_available", F.lit("unknown")).alias("scihub_available"),
        F.coalesce("downloaded", F.lit("unknown")).alias("downloaded"),
        F.when(F.col("u"), YES).otherwise(NO).alias("oa_available"),
        F.when(F.col("c"), YES).otherwise(NO).alias("has_content_in_db"),
        *[
            F.when(F.col(f"files_{p}") == 1, SUCCESS).otherwise(F.coalesce(F.col(f"_{p}"), F.lit(NOT_ATTEMPTED))).alias(f"{p}_status")
            for p in PARSERS
        ],
        F.coalesce("retry_count", F.lit("0")).alias("retry_count"),
    )


def reset_actions(identifiers: DataFrame, history: DataFrame, pdfs: DataFrame, bodies: DataFrame) -> DataFrame:
    """Plan of a reset: one row per listed identifier (``n_listed`` copies).

    ``identifiers(identifier)``, ``history(doi)`` of earlier resets, ``pdfs(stem, is_valid)``
    and ``bodies(stem, parser, length, body)``. An invalid PDF takes both extractions with
    it; otherwise each invalid extraction goes and its parser is marked failed. Nothing is
    deleted here.
    """
    judged = VA.with_validity(bodies).select("stem", F.col("parser").alias("kind"), "is_valid")
    tagged = judged.unionByName(pdfs.select("stem", F.lit("pdf").alias("kind"), "is_valid"))
    files = tagged.groupBy("stem").agg(
        *[F.min(F.when(F.col("kind") == k, F.col("is_valid"))).alias(f"{k}_ok") for k in ("pdf", *PARSERS)]
    )
    listed = identifiers.groupBy("identifier").agg(F.count(F.lit(1)).alias("n_listed"))
    keyed_list = listed.withColumn("doi", normalize_doi(F.col("identifier"))).withColumn(
        "_key", spread_key(F.col("doi"), F.col("identifier"))
    )
    earlier = history.select(F.col("doi").alias("_key"), F.lit(True).alias("was_reset")).distinct()
    joined = (
        keyed_list.join(earlier, "_key", "left")
        .withColumn("stem", stem_of(F.col("_key")))
        .join(files, "stem", "left")
    )
    skipped = F.coalesce(F.col("was_reset"), F.lit(False))
    active = ~skipped & F.col("doi").isNotNull()
    pdf_bad = active & is_value_false("pdf_ok")
    bad = {p: active & ~pdf_bad & is_value_false(f"{p}_ok") for p in PARSERS}
    dropped = {p: (pdf_bad & F.col(f"{p}_ok").isNotNull()) | bad[p] for p in PARSERS}
    return joined.select(
        "identifier", "doi", "n_listed",
        skipped.alias("skipped_previously_reset"), active.alias("reset_tracker"), pdf_bad.alias("invalid_pdf"),
        bad["grobid"].alias("invalid_grobid_json"), bad["pymupdf"].alias("invalid_pymupdf_json"),
        dropped["grobid"].alias("drop_grobid_json"), dropped["pymupdf"].alias("drop_pymupdf_json"),
    )


def is_value_false(column: str) -> Column:
    return F.col(column).eqNullSafe(F.lit(False))


def reset_statistics(actions: DataFrame) -> DataFrame:
    """One row with the eight counters of a reset.

    A repeat of an identifier resets again, but its files are gone after the first pass.
    """
    n, live = F.col("n_listed"), F.col("reset_tracker")
    flags = ("invalid_pdf", "invalid_grobid_json", "invalid_pymupdf_json", "drop_grobid_json", "drop_pymupdf_json")
    per_doi = actions.groupBy(spread_key(F.col("doi"), F.col("identifier")).alias("key")).agg(
        F.sum(F.when(~F.col("skipped_previously_reset"), n)).alias("total"),
        F.sum(F.when(F.col("skipped_previously_reset"), n)).alias("skipped"),
        F.sum(F.when(live, n)).alias("resets"),
        *[F.max(live & F.col(f)).alias(f) for f in flags],
    )

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0).cast("long"))

    return per_doi.agg(
        total("total").alias("total_dois"), total("skipped").alias("skipped_previously_reset"), total("resets").alias("tracker_reset"),
        F.count_if("invalid_pdf").alias("invalid_pdfs"), F.count_if("invalid_grobid_json").alias("invalid_grobid_jsons"),
        F.count_if("invalid_pymupdf_json").alias("invalid_pymupdf_jsons"), F.count_if("invalid_pdf").alias("pdfs_deleted"),
        (F.count_if("drop_grobid_json") + F.count_if("drop_pymupdf_json")).alias("jsons_deleted"),
    )


def reset_history(history: DataFrame, actions: DataFrame) -> DataFrame:
    return key_union(history, actions.filter("reset_tracker"))


def reset_events(actions: DataFrame) -> DataFrame:
    """``(doi, parser)`` failures the reset records after clearing a DOI."""
    parsers = F.array(
        F.when(F.col("invalid_grobid_json"), "grobid"), F.when(F.col("invalid_pymupdf_json"), "pymupdf")
    )
    return (
        actions.filter("reset_tracker")
        .select("doi", F.explode(F.filter(parsers, lambda p: p.isNotNull())).alias("parser"))
        .distinct()
        .withColumn("status", F.lit(FAILED))
    )

