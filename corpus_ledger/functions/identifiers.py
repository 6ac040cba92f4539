"""Identifier normalisation as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse_spaces, null_if_empty, strip

# Prefixes removed from an identifier, first match wins.
PIPELINE_PREFIXES = [
    "doi:",
    "doi.org/",
    "dx.doi.org/",
    "http://dx.doi.org/",
    "https://dx.doi.org/",
    "http://doi.org/",
    "https://doi.org/",
    "https://www.doi.org/",
    "http://www.doi.org/",
]
STRICT_PREFIXES = [
    "doi:",
    "doi.org/",
    "dx.doi.org/",
    "http://dx.doi.org/",
    "https://dx.doi.org/",
    "http://doi.org/",
    "https://doi.org/",
    "DOI:",
    "https://doi.org/doi:",
    "doi: ",
    "https://www.doi.org/",
    "http://www.doi.org/",
    "www.doi.org/",
    "doi.org/doi:",
]
# Marks of a DOI, its checked form, and the article path rewritten to one.
DOI_MARKS = ["10.", "doi:", "doi.org/", "dx.doi.org/"]
DOI_FORM = r"^10\.\p{Nd}{4,9}/[!-~]+$"
ARTICLE_PATH = r"/([a-z0-9\-]+)/\1\.xml$"
ARTICLE_REGISTRANT = "10.1515/"
FAST_SUFFIX = "_fast"


def _without_prefix(c: Column, prefixes: list[str]) -> Column:
    pattern = "(?i)^(?:" + "|".join(re.escape(p).replace(r"\ ", " ") for p in prefixes) + ")"
    return strip(F.regexp_replace(c, pattern, ""))


def normalize_doi(c: Column, mode: str = "pipeline") -> Column:
    """DOI of an identifier or NULL.

    ``pipeline`` rewrites article paths, needs a slash and keeps query strings;
    ``strict`` cuts the query string and trailing punctuation and needs no slash.
    """
    value = strip(c)
    if mode == "pipeline":
        article = F.regexp_extract(value, ARTICLE_PATH, 1)
        is_path = value.startswith("/j/") & value.endswith(".xml") & (article != "")
        out = F.when(is_path, F.concat(F.lit(ARTICLE_REGISTRANT), article)).otherwise(
            _without_prefix(value, PIPELINE_PREFIXES)
        )
        return F.when(out.startswith("10.") & out.contains("/"), out)
    if mode == "strict":
        out = F.substring_index(_without_prefix(value, STRICT_PREFIXES), "?", 1)
        out = F.rtrim(out, F.lit(".,;: "))
        return F.when(out.startswith("10."), out)
    raise ValueError(f"unknown mode {mode!r}")


def is_valid_doi(c: Column) -> Column:
    form = F.upper(strip(normalize_doi(c, "strict")))
    return F.coalesce(form.rlike(DOI_FORM), F.lit(False))


def identifier_type(c: Column) -> Column:
    value = F.lower(strip(c))
    doi_mark = F.lit(False)
    for mark in DOI_MARKS:
        doi_mark = doi_mark | value.contains(mark)
    return (
        F.when(value.isNull() | (c == ""), "title")
        .when(value.rlike(r"^\p{Nd}{6,}$"), "pmid")
        .when(value.startswith("pmid:") | value.startswith("pmid "), "pmid")
        .when(doi_mark, "doi")
        .otherwise("title")
    )


def normalize_pmid(c: Column) -> Column:
    value = strip(F.regexp_replace(strip(c), r"(?i)^pmid[: ]", ""))
    return F.when(value.rlike(r"^\p{Nd}+$"), value)


def is_valid_pmid(c: Column) -> Column:
    return F.coalesce(F.length(normalize_pmid(c)) >= 6, F.lit(False))


def stem_of(doi: Column) -> Column:
    """File stem of a DOI."""
    return F.translate(doi, "/", "_")


def doi_of_stem(stem: Column) -> Column:
    """Reverse mapping; lossy for DOIs holding an underscore, so used for orphan files only."""
    return F.translate(F.regexp_replace(stem, f"{FAST_SUFFIX}$", ""), "_", "/")


def metadata_doi(stem: Column) -> Column:
    doi = F.translate(stem, "_", "/")
    return F.when(doi.contains("/"), doi)


def safe_file_name(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)[^\w\-_.]", "_")


def clean_title(c: Column) -> Column:
    return null_if_empty(collapse_spaces(c))
