"""Fixed relation schemas (column names and value domains are part of the data model)."""

from __future__ import annotations

# Ledger domains.
YES, NO, UNKNOWN = "yes", "no", "unknown"
SUCCESS, FAILED, NOT_ATTEMPTED, IN_PROGRESS = "success", "failed", "not_attempted", "in_progress"
PARSERS = ("pymupdf", "grobid")
TRACKED_SOURCES = ("arxiv", "biorxiv", "europepmc", "unpaywall")

PAPERS = (
    "pmid STRING, pmcid STRING, doi STRING, title STRING, abstract STRING, full_text STRING, "
    "full_text_sections STRING, oa_url STRING, year STRING, parsing_status STRING"
)
EVALUATIONS = "doi STRING, result STRING, confidence_score DOUBLE"

# Ledger columns, in table order.
TRACKER_COLUMNS = [
    "scihub_available",
    "scihub_downloaded",
    "oa_available",
    "oa_downloaded",
    "arxiv_attempted",
    "arxiv_downloaded",
    "biorxiv_attempted",
    "biorxiv_downloaded",
    "europepmc_attempted",
    "europepmc_downloaded",
    "unpaywall_attempted",
    "unpaywall_downloaded",
    "downloaded",
    "download_date",
    "download_source",
    "has_content_in_db",
    "pymupdf_status",
    "pymupdf_date",
    "grobid_status",
    "grobid_date",
    "error_msg",
]
DATE_COLUMNS = ("download_date", "pymupdf_date", "grobid_date")


def tracker_type(column: str) -> str:
    return "timestamp" if column in DATE_COLUMNS else "string"


TRACKER = ", ".join(
    ["doi STRING"]
    + [f"{c} {tracker_type(c).upper()}" for c in TRACKER_COLUMNS]
    + ["last_updated TIMESTAMP", "retry_count INT"]
)
EVENTS = (
    "id BIGINT, doi STRING, event_type STRING, status_from STRING, status_to STRING, "
    "message STRING, created_at TIMESTAMP, changes MAP<STRING,STRING>"
)
# Header of the two tracker file versions.
TRACKER_FILE_V1 = (
    "doi STRING, scihub_available STRING, downloaded STRING, download_date STRING, "
    "pymupdf_status STRING, pymupdf_date STRING, grobid_status STRING, grobid_date STRING, "
    "last_updated STRING, error_msg STRING, retry_count STRING"
)
TRACKER_FILE_V2 = (
    "doi STRING, scihub_available STRING, scihub_downloaded STRING, oa_available STRING, "
    "oa_downloaded STRING, downloaded STRING, download_date STRING, has_content_in_db STRING, "
    "pymupdf_status STRING, pymupdf_date STRING, grobid_status STRING, grobid_date STRING, "
    "last_updated STRING, error_msg STRING, retry_count STRING"
)
# What a tracker file row holds before anything happened.
TRACKER_FILE_DEFAULTS = {
    "scihub_available": UNKNOWN,
    "scihub_downloaded": UNKNOWN,
    "oa_downloaded": UNKNOWN,
    "downloaded": UNKNOWN,
    "download_date": "",
    "pymupdf_status": NOT_ATTEMPTED,
    "pymupdf_date": "",
    "grobid_status": NOT_ATTEMPTED,
    "grobid_date": "",
    "error_msg": "",
    "retry_count": "0",
}
LAYOUT_BLOCKS = (
    "doc_id BIGINT, page INT, block INT, line INT, span INT, text STRING, size DOUBLE, flags INT"
)
SECTIONS = "array<struct<pos:int,title:string,content:string>>"
