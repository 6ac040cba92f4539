"""URL clean-up, host labels and URLs derived from identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Repository label by URL part, first match wins.
HOST_LABELS = [
    (["arxiv.org"], "arXiv"),
    (["biorxiv.org", "medrxiv.org"], "bioRxiv/medRxiv"),
    (["ncbi.nlm.nih.gov/pmc"], "PubMed Central"),
    (["europepmc.org"], "Europe PMC"),
    (["researchgate.net"], "ResearchGate"),
]
OTHER_HOST = "Other repository"
DOI_REDIRECTS = ["https://doi.org/", "http://dx.doi.org/"]
PUBLISHER_HOST = "sciencedirect.com"
PDF_LINK = r"""(?i)(https://[^\s'"]+\.pdf)"""


def _resolve_dots(path: Column) -> Column:
    """Fold ``.`` and ``..`` segments of an absolute path."""
    empty = F.array().cast("array<string>")
    segments = F.split(path, "/")
    folded = F.aggregate(
        segments,
        empty,
        lambda acc, s: F.when(s == ".", acc)
        .when((s == "..") & (F.size(acc) > 1), F.slice(acc, F.lit(1), F.size(acc) - 1))
        .when(s == "..", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    return F.array_join(folded, "/")


def canonical_url(url: Column, base: Column | None = None) -> Column:
    """Absolute https URL without fragment; relative URLs are resolved against ``base``."""
    absolute = url.rlike("^https?://")
    if base is None:
        relative = F.concat(F.lit("https://"), F.ltrim(url, F.lit("/")))
    else:
        root = F.regexp_extract(base, r"^(https?://[^/?#]+)", 1)
        base_path = F.regexp_extract(base, r"^https?://[^/?#]+([^?#]*)", 1)
        folder = F.regexp_replace(base_path, "[^/]*$", "")
        folder = F.when(folder == "", F.lit("/")).otherwise(folder)
        own_path = F.regexp_extract(url, "^([^?#]*)", 1)
        rest = F.regexp_extract(url, "^[^?#]*(.*)$", 1)
        full = F.when(own_path.startswith("/"), own_path).otherwise(F.concat(folder, own_path))
        relative = F.concat(root, _resolve_dots(full), rest)
    out = (
        F.when(url.startswith("www."), F.concat(F.lit("https://"), url))
        .when(url.startswith("//"), F.concat(F.lit("https:"), url))
        .when(absolute, url)
        .otherwise(relative)
    )
    return F.substring_index(out, "#", 1)


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def is_publisher_host(url: Column) -> Column:
    return F.coalesce(url_host(url).contains(PUBLISHER_HOST), F.lit(False))


def is_doi_redirect(url: Column) -> Column:
    hit = F.lit(False)
    for prefix in DOI_REDIRECTS:
        hit = hit | url.startswith(prefix)
    return F.coalesce(hit, F.lit(False))


def repository_label(url: Column) -> Column:
    """Label of the repository that hosts a PDF; NULL for redirects and absent URLs."""
    label = F.when(url.isNull() | (url == "") | is_doi_redirect(url), F.lit(None).cast("string"))
    for parts, name in HOST_LABELS:
        hit = F.lit(False)
        for part in parts:
            hit = hit | url.contains(part)
        label = label.when(hit, name)
    return label.otherwise(OTHER_HOST)


def _extract(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def pii_of_url(url: Column) -> Column:
    return _extract(url, r"(?i)/pii/([A-Z0-9]+)")


def pii_of_page(url: Column, html: Column) -> Column:
    """Item identifier of a publisher page: URL, then meta tag, then page text."""
    meta = F.coalesce(
        _extract(html, r"""(?is)<meta\b[^>]*\bname=["']citation_pii["'][^>]*\bcontent=["']([^"']*)["']"""),
        _extract(html, r"""(?is)<meta\b[^>]*\bcontent=["']([^"']*)["'][^>]*\bname=["']citation_pii["']"""),
    )
    return F.coalesce(_extract(url, "/pii/([A-Z0-9]+)"), meta, _extract(html, r"PII:\s*([A-Z0-9]+)"))


def publisher_pdf_urls(pii: Column) -> Column:
    root = F.lit("https://www.sciencedirect.com/science/article/pii/")
    return F.when(
        pii.isNotNull(),
        F.array(F.concat(root, pii, F.lit("/pdfft")), F.concat(root, pii, F.lit("/pdf"))),
    )


def arxiv_pdf_url(doi: Column) -> Column:
    ident = F.replace(F.substring_index(doi, "/", -1), F.lit("arxiv."), F.lit(""))
    return F.when(
        F.lower(doi).contains("arxiv"),
        F.concat(F.lit("https://arxiv.org/pdf/"), ident, F.lit(".pdf")),
    )


def preprint_pdf_url(doi: Column) -> Column:
    return F.when(
        doi.contains("10.1101/"),
        F.concat(F.lit("https://www.biorxiv.org/content/"), doi, F.lit("v1.full.pdf")),
    )


def candidate_urls(doi: Column, pii: Column | None = None) -> Column:
    """All URLs a DOI (and an optional item identifier) implies, most specific first."""
    found = F.array(arxiv_pdf_url(doi), preprint_pdf_url(doi))
    if pii is not None:
        found = F.concat(found, F.coalesce(publisher_pdf_urls(pii), F.array().cast("array<string>")))
    return F.filter(found, lambda u: u.isNotNull())


def first_pdf_link(html: Column) -> Column:
    return _extract(html, PDF_LINK)
