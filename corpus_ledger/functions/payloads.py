"""Best PDF URL and identifiers out of stored provider responses (JSON or Atom text)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import has_text_sql, null_if_empty
from .urls import is_doi_redirect, repository_label

LOCATION = "struct<url_for_pdf:string,pdf_url:string,url:string>"
UNPAYWALL = f"struct<is_oa:boolean,best_oa_location:{LOCATION},oa_locations:array<{LOCATION}>>"
PLACE = "struct<pdf_url:string,source:struct<pdf_url:string>>"
OPENALEX = f"struct<primary_location:{PLACE},locations:array<{PLACE}>,oa_locations:array<{PLACE}>>"
SEMANTIC_SCHOLAR = (
    "struct<title:string,year:int,venue:string,isOpenAccess:boolean,openAccessPdf:struct<url:string>>"
)
EUROPE_PMC = (
    "struct<resultList:struct<result:array<struct<pmcid:string,fullTextUrlList:"
    "struct<fullTextUrl:array<struct<availability:string,url:string>>>>>>>"
)
CROSSREF = "struct<message:struct<items:array<struct<DOI:string,score:double>>>>"
ARTICLE_IDS = "array<struct<idtype:string,value:string>>"
# Fixed value: lowest title-match score that is trusted.
MIN_TITLE_SCORE = 35.0


def _first_url(locations: Column, url_of) -> Column:
    """First location with a URL; a null entry ends the search, as nothing after it is read."""
    locations = F.coalesce(locations, F.array().cast(f"array<{LOCATION}>"))
    return _scan(locations, url_of)


def _scan(locations: Column, url_of) -> Column:
    gap = F.array_position(F.transform(locations, lambda x: x.isNull()), True)
    readable = F.when(gap > 0, F.slice(locations, F.lit(1), (gap - 1).cast("int"))).otherwise(locations)
    return F.get(F.filter(F.transform(readable, url_of), lambda u: u.isNotNull()), F.lit(0))


def unpaywall_pdf_url(payload: Column) -> Column:
    doc = F.from_json(payload, UNPAYWALL)
    best = F.filter(F.array(doc["best_oa_location"]), lambda x: x.isNotNull())
    rest = F.coalesce(doc["oa_locations"], F.array().cast(f"array<{LOCATION}>"))
    return _first_url(
        F.concat(best, rest),
        lambda x: F.coalesce(null_if_empty(x["url_for_pdf"]), null_if_empty(x["pdf_url"]), null_if_empty(x["url"])),
    )


def openalex_pdf_url(payload: Column) -> Column:
    doc = F.from_json(payload, OPENALEX)

    def url_of(x: Column) -> Column:
        return F.coalesce(null_if_empty(x["pdf_url"]), null_if_empty(x["source"]["pdf_url"]))

    listed = F.when(F.size(doc["locations"]) > 0, doc["locations"]).otherwise(doc["oa_locations"])
    return F.coalesce(url_of(doc["primary_location"]), _scan(listed, url_of))


def semantic_scholar_pdf_url(payload: Column) -> Column:
    return F.from_json(payload, SEMANTIC_SCHOLAR)["openAccessPdf"]["url"]


def semantic_scholar_record(payload: Column) -> Column:
    doc = F.from_json(payload, SEMANTIC_SCHOLAR)
    raw = null_if_empty(doc["openAccessPdf"]["url"])
    url = F.when(~is_doi_redirect(raw), raw)
    return F.struct(
        url.alias("pdf_url"),
        F.coalesce(doc["isOpenAccess"], F.lit(False)).alias("open_access"),
        F.coalesce(doc["title"], F.lit("")).alias("title"),
        doc["year"].alias("year"),
        F.coalesce(doc["venue"], F.lit("")).alias("venue"),
        repository_label(url).alias("pdf_source"),
    )


def europe_pmc_pdf_url(payload: Column) -> Column:
    first = F.get(F.from_json(payload, EUROPE_PMC)["resultList"]["result"], F.lit(0))
    free = F.filter(
        first["fullTextUrlList"]["fullTextUrl"],
        lambda u: (u["availability"] == "Free") & has_text_sql(u["url"]),
    )
    url = F.get(free, F.lit(0))["url"]
    render = F.concat(F.lit("https://europepmc.org/articles/"), first["pmcid"], F.lit("?pdf=render"))
    landing = url.contains("europepmc.org") & url.contains("PMC") & has_text_sql(first["pmcid"])
    return F.when(landing, render).otherwise(url)


def doi_of_pmid(pmid: Column, payload: Column) -> Column:
    path = F.concat(F.lit("$.result['"), pmid, F.lit("'].articleids"))
    ids = F.call_function("get_json_object", payload, path)  # the path differs by row
    listed = F.filter(F.from_json(ids, ARTICLE_IDS), lambda x: x["idtype"] == "doi")
    return F.get(listed, F.lit(0))["value"]


def doi_of_title(payload: Column) -> Column:
    top = F.get(F.from_json(payload, CROSSREF)["message"]["items"], F.lit(0))
    return F.when(top["score"] > MIN_TITLE_SCORE, null_if_empty(top["DOI"]))


def arxiv_search_pdf_url(feed: Column) -> Column:
    ident = F.regexp_extract(feed, "<id>http://arxiv.org/abs/([^<]+)</id>", 1)
    return F.when(
        feed.contains("<entry>") & (ident != ""),
        F.concat(F.lit("https://arxiv.org/pdf/"), ident, F.lit(".pdf")),
    )


def open_access_url(payload: Column) -> Column:
    """URL of an open-access record that names a PDF, else NULL."""
    doc = F.from_json(payload, UNPAYWALL)
    return F.when(doc["is_oa"], null_if_empty(doc["best_oa_location"]["url_for_pdf"]))
