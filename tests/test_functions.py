"""Literal cases of identifiers, URLs, status texts, payloads and file checks."""

import json

import pytest
from pyspark.sql import functions as F

from corpus_ledger.functions import identifiers as I
from corpus_ledger.functions import payloads as P
from corpus_ledger.functions import status as S
from corpus_ledger.functions import text as T
from corpus_ledger.functions import urls as U
from corpus_ledger.functions import validity as VA

V = F.col("v")


def test_pipeline_doi(column):
    cases = {
        "10.1038/x": "10.1038/x",
        "DOI:10.1/x": "10.1/x",
        "https://doi.org/10.1/x": "10.1/x",
        "https://doi.org/doi:10.1/x": None,
        "/j/ab/ab-1/ab-1.xml": "10.1515/ab-1",
        "/j/ab/ab-1/ab-2.xml": None,
        "95/4/1706": None,
        "10.1/x?y.": "10.1/x?y.",
        "10.1": None,
        " \t10.2/z\n": "10.2/z",
        "HTTP://WWW.DOI.ORG/10.3/q": "10.3/q",
        "": None,
        None: None,
    }
    assert column(I.normalize_doi(V), list(cases)) == list(cases.values())


def test_strict_doi(column):
    cases = {
        "10.1/x?y.": "10.1/x",
        "10.1": "10.1",
        "https://doi.org/doi:10.1/x": None,
        "www.doi.org/10.5/a.,;: ": "10.5/a",
        "doi: 10.7/b": "10.7/b",
        "abc": None,
        "": None,
        None: None,
    }
    assert column(I.normalize_doi(V, "strict"), list(cases)) == list(cases.values())
    with pytest.raises(ValueError):
        I.normalize_doi(V, "loose")


def test_valid_doi(column):
    cases = {"10.1038/x": True, "10.1/x": False, "10.12345/a<b>;#c": True, "10.1038/é": False, "10.1038/a b": False, None: False}
    assert column(I.is_valid_doi(V), list(cases)) == list(cases.values())


def test_identifier_type(column):
    cases = {
        "32265220": "pmid", "12345": "title", "PMID: 123456": "pmid", "pmid 9": "pmid", "top 10. things": "doi",
        "see DX.DOI.ORG/x": "doi", "Aging and senescence": "title", "": "title", None: "title", "   ": "title",
    }
    assert column(I.identifier_type(V), list(cases)) == list(cases.values())


def test_pmid(column):
    cases = {"32265220": "32265220", "PMID: 123456": "123456", "pmid 77": "77", "pmid:": None, "12a": None, None: None}
    assert column(I.normalize_pmid(V), list(cases)) == list(cases.values())
    assert column(I.is_valid_pmid(V), ["123456", "12345", "PMID:1234567", "x", None]) == [True, False, True, False, False]


def test_names(one):
    assert one(I.stem_of(V), v="10.1/a/b") == "10.1_a_b"
    assert one(I.doi_of_stem(V), v="10.1_a_fast") == "10.1/a"
    assert one(I.doi_of_stem(V), v="10.1_fast_track") == "10.1/fast/track"
    assert one(I.metadata_doi(V), v="report") is None
    assert one(I.safe_file_name(V), v="10.1/é<a>-b") == "10.1_é_a_-b"
    assert one(I.clean_title(V), v="  a \n b\t c ") == "a b c"


def test_urls(column, one):
    base = F.lit("https://host.org/x/y.html?q=1")
    cases = {
        "www.a.org/p": "https://www.a.org/p", "//b.org/p#f": "https://b.org/p", "http://c.org/p#a#b": "http://c.org/p",
        "/d/../e.pdf": "https://host.org/e.pdf", "f.pdf": "https://host.org/x/f.pdf", "../../g.pdf?k=1": "https://host.org/g.pdf?k=1",
    }
    assert column(U.canonical_url(V, base), list(cases)) == list(cases.values())
    assert one(U.canonical_url(V), v="h.org/p") == "https://h.org/p"
    assert column(U.is_publisher_host(V), ["https://www.ScienceDirect.com/a", "https://x.org/sciencedirect.com", None]) == [True, False, False]
    assert one(U.pii_of_url(V), v="https://x/PII/s0123X?a") == "s0123X"
    assert one(U.pii_of_page(V, F.col("h")), v="https://x/", h='<meta name="citation_pii" content="S1"> PII: Q2') == "S1"
    assert one(U.pii_of_page(V, F.col("h")), v="https://x/pii/Z9", h="") == "Z9"
    assert one(U.arxiv_pdf_url(V), v="10.48550/arxiv.2101.1") == "https://arxiv.org/pdf/2101.1.pdf"
    assert one(U.arxiv_pdf_url(V), v="10.48550/arXiv.2101.1") == "https://arxiv.org/pdf/arXiv.2101.1.pdf"
    assert one(U.preprint_pdf_url(V), v="10.1/x") is None
    assert one(U.candidate_urls(V), v="10.1101/7") == ["https://www.biorxiv.org/content/10.1101/7v1.full.pdf"]


def test_strip_set(one):
    assert one(T.strip(V), v="　\x1c a\xa0b  ") == "a\xa0b"
    assert one(T.has_text(V), v=" \n ") is False
    assert one(T.is_blank_sql(V), v=" ") is False


def encode(one, **kw):
    state = {"grobid": None, "pymupdf": None, "downloaded": None, "available": None, **kw}
    return one(S.encode_status(*[F.col(c) for c in state]), **state)


def test_encode_status(one):
    assert encode(one, grobid="success", pymupdf="success") == "success (parser: grobid)"
    assert encode(one, pymupdf="success", grobid="failed") == "success (parser: PyMuPDF)"
    assert encode(one, grobid="failed", pymupdf="failed") == "processing_failed (parser: grobid)"
    assert encode(one, pymupdf="failed", downloaded="no") == "processing_failed (parser: PyMuPDF)"
    assert encode(one, downloaded="no", available="no") == "download_failed"
    assert encode(one, available="no") == "not_found"
    assert encode(one) == "not_processed"


def decode(one, columns, **values):
    return {k: v for k, v in one(F.struct(*[c.alias(n) for n, c in columns.items()]), **values).asDict().items() if v}


@pytest.mark.parametrize(
    ("status", "plain", "initial"),
    [
        ("success (parser: grobid)", {"grobid_status": "success", "downloaded": "yes"}, {"scihub_available": "yes", "downloaded": "yes", "grobid_status": "success"}),
        ("Success PYMUPDF then failed", {"pymupdf_status": "failed", "downloaded": "yes"}, {"scihub_available": "yes", "downloaded": "yes", "pymupdf_status": "success"}),
        ("processing_failed (parser: grobid)", {"grobid_status": "failed"}, {"scihub_available": "yes", "downloaded": "yes", "grobid_status": "failed"}),
        ("success pymupdf | grobid: success", {"grobid_status": "success", "downloaded": "yes"}, {"scihub_available": "yes", "downloaded": "yes", "pymupdf_status": "success", "grobid_status": "success"}),
        ("not_found", {"scihub_available": "no"}, {"scihub_available": "no", "downloaded": "no"}),
        ("download_failed", {}, {"downloaded": "no"}),
        ("not required - already populated", {}, {"scihub_available": "yes", "downloaded": "yes", "pymupdf_status": "success"}),
        ("no DOI available", {}, {}),
        ("not processed - not found in logs", {}, {"pymupdf_status": "not_attempted", "grobid_status": "not_attempted"}),
        ("", {}, {}),
        (None, {}, {}),
    ],
)
def test_decode_status(one, status, plain, initial):
    assert decode(one, S.decode_status(V), v=status) == plain
    assert decode(one, S.decode_initial(V, F.col("a"), F.col("s")), v=status, a="text", s=None) == initial


def test_decode_initial_without_content(one):
    got = decode(one, S.decode_initial(V, F.col("a"), F.col("s")), v="already populated", a="", s=None)
    assert got == {"scihub_available": "yes", "downloaded": "yes"}


def test_log_status(one):
    assert one(S.log_status(V, F.col("p")), v="success", p="grobid") == "success (parser: grobid)"
    assert one(S.log_status(V, F.col("p")), v="success", p=None) == "success"


def test_unpaywall_order(one):
    def url(doc):
        return one(P.unpaywall_pdf_url(V), v=json.dumps(doc))

    assert url({"best_oa_location": {"url_for_pdf": "a"}, "oa_locations": [{"url": "b"}]}) == "a"
    assert url({"best_oa_location": {"url_for_pdf": None, "url": ""}, "oa_locations": [{"pdf_url": "b"}]}) == "b"
    assert url({"oa_locations": []}) is None
    assert url({"oa_locations": [None, {"url": "b"}]}) is None
    assert one(P.unpaywall_pdf_url(V), v="{bad") is None
    assert one(P.open_access_url(V), v='{"is_oa": true, "best_oa_location": {"url_for_pdf": "a"}}') == "a"
    assert one(P.open_access_url(V), v='{"is_oa": false, "best_oa_location": {"url_for_pdf": "a"}}') is None


def test_other_providers(one):
    assert one(P.openalex_pdf_url(V), v='{"primary_location": {"source": {"pdf_url": "s"}}}') == "s"
    assert one(P.semantic_scholar_pdf_url(V), v='{"openAccessPdf": null}') is None
    record = one(P.semantic_scholar_record(V), v='{"openAccessPdf": {"url": "https://doi.org/10.1/x"}, "isOpenAccess": true}')
    assert (record["pdf_url"], record["pdf_source"], record["open_access"], record["title"]) == (None, None, True, "")
    pmc = '{"resultList": {"result": [{"pmcid": "PMC1", "fullTextUrlList": {"fullTextUrl": [{"availability": "Free", "url": "https://europepmc.org/articles/PMC1"}]}}]}}'
    assert one(P.europe_pmc_pdf_url(V), v=pmc) == "https://europepmc.org/articles/PMC1?pdf=render"
    assert one(P.europe_pmc_pdf_url(V), v='{"resultList": {"result": []}}') is None
    assert one(P.doi_of_title(V), v='{"message": {"items": [{"DOI": "10.1/a", "score": 35.0}]}}') is None
    assert one(P.doi_of_title(V), v='{"message": {"items": [{"DOI": "10.1/a", "score": 35.1}]}}') == "10.1/a"
    assert one(P.arxiv_search_pdf_url(V), v="<feed><id>http://arxiv.org/abs/1</id></feed>") is None


PAD = b"x" * 5000


@pytest.mark.parametrize(
    ("content", "valid"),
    [
        (b"%PDF-" + b"x" * 1013 + b"%%EOF", False),  # 1023 bytes
        (b"%PDF-" + b"x" * 1014 + b"%%EOF", True),  # 1024 bytes
        (b"%PDX-" + b"x" * 2000 + b"%%EOF", False),
        (b"%PDF-" + PAD + b"%%EOF" + b"y" * 4091, True),  # trailer starts 4096 from the end
        (b"%PDF-" + PAD + b"%%EOF" + b"y" * 4092, False),
        (b"%PDF-%%EOF" + b"y" * 2000, True),  # shorter than the tail
        (b"%PDF-" + b"x" * 4000, False),
        (b"", False),
    ],
)
def test_valid_pdf(spark, content, valid):
    df = spark.createDataFrame([(len(content), bytearray(content))], "length long, content binary")
    assert df.select(VA.is_valid_pdf(F.col("length"), F.col("content"))).first()[0] is valid


T50, T49 = "y" * 50, "y" * 49
BODIES = [
    # parser, body, valid, state of the content check, filled section list
    ("grobid", {"metadata": {"title": "abcde"}}, True, "Empty content", (True, False)),
    ("grobid", {"metadata": {"title": "abcd "}}, False, "Empty content", (True, False)),
    ("grobid", {"metadata": {"title": 123456789}}, False, "Empty content", (True, False)),
    ("grobid", {"metadata": {"authors": [{}]}}, True, "Empty content", (True, False)),
    ("grobid", {"metadata": {"authors": [], "author": ["a"]}}, True, "Empty content", (True, False)),
    ("grobid", {"metadata": {"authors": "a", "author": ["a"]}}, False, "Empty content", (True, False)),
    ("grobid", {"full_text": T50}, True, "Error", (False, False)),
    ("grobid", {"full_text": T49, "fullText": T50}, False, "Error", (False, False)),
    ("grobid", {"full_text": "", "fullText": T50}, True, "Error", (False, False)),
    ("grobid", {"full_text": {"body": [{"content": T49}, {"content": " z "}]}}, True, None, (True, True)),
    ("grobid", {"full_text": {"body": [{"content": ["a", "b"]}]}, "x": 1}, False, None, (True, True)),
    ("grobid", {"full_text": {"body": ["a"]}}, False, "Error", (True, True)),
    ("grobid", {"full_text": {"body": [{"content": "a"}, "b"]}}, False, None, (True, True)),
    ("grobid", {"full_text": {"body": None}}, False, "Error", (False, False)),
    ("grobid", {"sections": [{"text": T49}, {"text": T50}]}, True, "Empty content", (True, False)),
    ("grobid", {}, False, "Empty content", (True, False)),
    ("pymupdf", {"structured_text": {"full_text": T50}}, True, "Empty content", (True, False)),
    ("pymupdf", {"structured_text": {"sections": [{"content": [T49, " q "]}]}}, True, None, (True, True)),
    ("pymupdf", {"structured_text": {"sections": [{"content": T50}]}}, False, None, (True, True)),
    ("pymupdf", {"structured_text": {"pages": [{"b": {"text": T49}}, {"text": " k "}]}}, True, "Empty content", (True, False)),
    ("pymupdf", {"structured_text": {"pages": [{"text": T49}]}}, False, "Empty content", (True, False)),
    ("pymupdf", {"structured_text": {}}, False, "Empty content", (True, False)),
    ("pymupdf", {"text": T50 * 3, "mode": "simple"}, False, "Empty content", (True, False)),
    ("pymupdf", {"structured_text": {"sections": [{"content": []}]}}, False, "Empty content", (True, True)),
]


def test_json_checks(spark):
    rows = [(i, p, len(json.dumps(b)), json.dumps(b)) for i, (p, b, *_rest) in enumerate(BODIES)]
    rows += [(90, "grobid", 30, '{"metadata": {"title": "abcde"'), (91, "grobid", 30, '["' + T50 + '"]'), (92, "pymupdf", 9, '{"a": 1}')]
    df = spark.createDataFrame(rows, "i int, parser string, length long, body string")
    valid = {r["i"]: r["is_valid"] for r in VA.with_validity(df).collect()}
    state = {r["i"]: (r["is_valid"], r["has_content"], r["reason"]) for r in VA.with_content_check(df).collect()}
    listed = {r["i"]: (r["is_valid"], r["has_content"]) for r in VA.with_section_list_check(df).collect()}
    plain = {r["i"]: r["is_plain"] for r in VA.with_plain_check(df).collect()}
    for i, (_parser, body, ok, reason, weak) in enumerate(BODIES):
        assert valid[i] is ok, body
        assert state[i] == (reason in (None, "Empty content"), reason is None, reason), body
        assert listed[i] == weak, body
    assert (valid[90], state[90], listed[90], plain[90]) == (False, (False, False, "Invalid JSON"), (False, False), False)
    assert (valid[91], state[91], plain[91]) == (False, (False, False, "Error"), False)
    assert plain[92] is False and plain[0] is True


def test_lenient_pdf(spark):
    df = spark.createDataFrame([("a" * 199, 0), ("a" * 200, 0), (None, 1), ("", None)], "t string, n int")
    got = [r[0] for r in df.select(VA.is_lenient_pdf(F.col("t"), F.col("n"))).collect()]
    assert got == [False, True, True, False]
