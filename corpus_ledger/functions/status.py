"""Encoding and decoding of the free-text ``parsing_status`` column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import FAILED, NO, NOT_ATTEMPTED, SUCCESS, YES
from .text import contains_ci, has_text_sql, is_value

# Status texts stored in the paper table.
DONE = {"grobid": "success (parser: grobid)", "pymupdf": "success (parser: PyMuPDF)"}
BROKEN = {
    "grobid": "processing_failed (parser: grobid)",
    "pymupdf": "processing_failed (parser: PyMuPDF)",
}
ALREADY_POPULATED = "not required - already populated"
NOT_IN_LOGS = "not processed - not found in logs"
NO_DOI = "no DOI available"
PARSER_LABEL = {"grobid": "grobid", "pymupdf": "PyMuPDF"}


def encode_status(grobid: Column, pymupdf: Column, downloaded: Column, available: Column) -> Column:
    return (
        F.when(grobid == SUCCESS, DONE["grobid"])
        .when(pymupdf == SUCCESS, DONE["pymupdf"])
        .when(grobid == FAILED, BROKEN["grobid"])
        .when(pymupdf == FAILED, BROKEN["pymupdf"])
        .when(downloaded == NO, "download_failed")
        .when(available == NO, "not_found")
        .otherwise("not_processed")
    )


def decode_status(status: Column) -> dict[str, Column]:
    """Ledger columns a status text implies; all NULL when it implies nothing."""
    ok, bad = contains_ci(status, "success"), contains_ci(status, "failed")
    is_structured = contains_ci(status, "grobid")
    is_fast = contains_ci(status, "pymupdf") & ~is_structured
    outcome = F.when(bad, FAILED).when(ok, SUCCESS)
    return {
        "scihub_available": F.when(contains_ci(status, "not_found"), NO),
        "downloaded": F.when(ok & (is_structured | is_fast), YES),
        "pymupdf_status": F.when(is_fast, outcome),
        "grobid_status": F.when(is_structured, outcome),
    }


def decode_initial(status: Column, abstract: Column, sections: Column) -> dict[str, Column]:
    """The seeding variant: it also infers download and availability from the text."""
    ok, bad = contains_ci(status, "success"), contains_ci(status, "failed")
    ran = ok | contains_ci(status, "parser")
    missing = contains_ci(status, "not_found")
    populated = contains_ci(status, "already populated")
    untouched = contains_ci(status, "not processed")
    skipped = contains_ci(status, "no doi")
    has_any = has_text_sql(abstract) | has_text_sql(sections)

    def outcome(word: str) -> Column:
        return F.when(
            contains_ci(status, word),
            F.when(ok, SUCCESS).when(bad, FAILED).otherwise(NOT_ATTEMPTED),
        )

    columns = {
        "scihub_available": F.when(populated | ran, YES).when(missing, NO),
        "downloaded": F.when(populated | ran, YES).when(missing | bad, NO),
        "pymupdf_status": F.when(untouched, NOT_ATTEMPTED)
        .when(populated & has_any, SUCCESS)
        .otherwise(outcome("pymupdf")),
        "grobid_status": F.when(untouched, NOT_ATTEMPTED).otherwise(outcome("grobid")),
    }
    return {name: F.when(~skipped, value) for name, value in columns.items()}


def import_status(
    override: Column, old: Column, tracked: Column, pymupdf: Column, grobid: Column, parser: Column
) -> Column:
    """Status text after an import; ``parser`` is the key of the extraction that was used."""
    fast_ok = tracked & is_value(pymupdf, SUCCESS)
    structured_ok = tracked & is_value(grobid, SUCCESS)
    from_ledger = F.concat_ws(
        " | ",
        F.when(fast_ok, DONE["pymupdf"]),
        F.when(structured_ok & fast_ok, "grobid: success").when(structured_ok, DONE["grobid"]),
    )
    return (
        F.when(override, F.concat(old, F.lit(" | grobid: success")))
        .when(from_ledger != "", from_ledger)
        .otherwise(F.concat(F.lit("parser: "), parser_label(parser)))
    )


def parser_label(parser: Column) -> Column:
    return F.when(parser == "pymupdf", PARSER_LABEL["pymupdf"]).otherwise(parser)


def log_status(result: Column, parser: Column) -> Column:
    return F.when(
        has_text_sql(parser), F.concat(result, F.lit(" (parser: "), parser, F.lit(")"))
    ).otherwise(result)
