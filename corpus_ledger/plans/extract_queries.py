"""Layout, JSON, TEI, provider payloads and logs."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F

from .. import fixtures
from ..functions import payloads as P
from ..functions.identifiers import metadata_doi
from ..operators import extraction, merge, sections, tei
from ..session import scratch_folder
from ..sources import files, logs
from .gap_queries import LABEL_SQL, MIRRORS, WS
from .registry import Source, query

# Layout rows of the fixture: one line is one block, four blocks are a page.
BLOCKS = f"""
WITH l AS (SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS n, unnest(string_split(text, chr(10))) AS row FROM documents),
s AS (SELECT doc_id, n, trim(row, {WS}) AS t, CASE WHEN contains(row, ' ') THEN 2 ELSE 1 END AS parts,
 CASE WHEN len(string_split(row, ' ')) < 6 THEN 16.0::DOUBLE ELSE 10.0::DOUBLE END AS size, n % 9 = 5 AS bold FROM l),
a AS (SELECT doc_id, coalesce(sum(size * parts) FILTER (WHERE n < 20) / sum(parts) FILTER (WHERE n < 20), 12.0) AS avg_size FROM s GROUP BY doc_id),
b AS (SELECT s.*, (bold OR size > avg_size * 1.2) AND len(string_split(trim(regexp_replace(t, '[[:space:]]+', ' ', 'g')), ' ')) < 15 AS head FROM s JOIN a ON s.doc_id = a.doc_id WHERE t <> ''),
g AS (SELECT *, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS section FROM b),
sec AS (SELECT doc_id, CAST(section AS BIGINT) AS section, coalesce(max(t) FILTER (WHERE head), 'Introduction') AS title, count(*) FILTER (WHERE NOT head) AS n_blocks,
 md5(coalesce(string_agg(t, chr(10) || chr(10) ORDER BY n) FILTER (WHERE NOT head), '')) AS content_md5 FROM g GROUP BY doc_id, section)
"""


TEXTS = """SELECT s.doc_id, coalesce(md5(f.t), md5('')) AS text_md5, s.page_count FROM (SELECT doc_id, CAST(max(n) // 4 + 1 AS INT) AS page_count FROM s GROUP BY doc_id) s
LEFT JOIN (SELECT doc_id, string_agg(t, chr(10) || chr(10) ORDER BY n) AS t FROM b GROUP BY doc_id) f ON s.doc_id = f.doc_id"""


@query("average_font", sql=BLOCKS + "SELECT doc_id, round(avg_size, 6) AS avg_size FROM a")
def average_font(spark, sf_dir):
    return sections.average_font(Source(spark, sf_dir).spans).select("doc_id", F.round("avg_size", 6).alias("avg_size"))


@query(
    "heading_blocks",
    sql=BLOCKS + "SELECT doc_id, CAST(n // 4 AS INT) AS page, CAST(n % 4 AS INT) AS block, t AS text, head AS is_heading FROM b",
)
def heading_blocks(spark, sf_dir):
    return sections.with_headings(Source(spark, sf_dir).spans).select("doc_id", "page", "block", "text", "is_heading")


@query("sections_from_blocks", sql=BLOCKS + "SELECT * FROM sec")
def sections_from_blocks(spark, sf_dir):
    return sections.sections(Source(spark, sf_dir).spans).select(
        "doc_id", F.col("section").cast("long").alias("section"), "title", F.size("content").cast("long").alias("n_blocks"),
        F.md5(F.array_join("content", "\n\n")).alias("content_md5"),
    )


@query(
    "full_text_join",
    sql=BLOCKS + TEXTS,
)
def full_text_join(spark, sf_dir):
    return sections.full_texts(Source(spark, sf_dir).spans).select("doc_id", F.md5("full_text").alias("text_md5"), "page_count")


# Titles and contents of all sections of a document, in order.
CONTENTS = "string_agg(title || ':' || n_blocks || ':' || content_md5, ',' ORDER BY section)"


def _contents(listed):
    line = lambda s: F.concat_ws(":", s["title"], F.size(s["content"]), F.md5(F.array_join(s["content"], "\n\n")))
    return F.md5(F.array_join(F.transform(F.coalesce(listed, F.array().cast("array<struct<title:string,content:array<string>>>")), line), ","))


@query(
    "structured_mode",
    sql=BLOCKS + f"""SELECT d.doc_id, 'structured' AS mode, coalesce(x.n, 0) AS n_sections, x.first_title, md5(coalesce(x.c, '')) AS contents_md5 FROM documents d
LEFT JOIN (SELECT doc_id, count(*) AS n, arg_min(title, section) AS first_title, {CONTENTS} AS c FROM sec GROUP BY doc_id) x ON d.doc_id = x.doc_id""",
)
def structured_mode(spark, sf_dir):
    docs = sections.structured_documents(Source(spark, sf_dir).spans, "structured")
    listed = F.col("structured_text.sections")
    return docs.select(
        "doc_id", "mode", F.coalesce(F.array_size(listed), F.lit(0)).cast("long").alias("n_sections"), F.get(listed, F.lit(0))["title"].alias("first_title"),
        _contents(listed).alias("contents_md5"),
    )


@query("simple_mode", sql=BLOCKS + f"SELECT doc_id, 'simple' AS mode, text_md5 FROM ({TEXTS}) x")
def simple_mode(spark, sf_dir):
    docs = sections.structured_documents(Source(spark, sf_dir).spans, "simple")
    return docs.select("doc_id", "mode", F.md5("text").alias("text_md5"))


@query(
    "full_mode",
    sql=BLOCKS + f"""SELECT x.doc_id, 'full' AS mode, text_md5, page_count, md5(coalesce(c.c, '')) AS contents_md5 FROM ({TEXTS}) x
LEFT JOIN (SELECT doc_id, {CONTENTS} AS c FROM sec GROUP BY doc_id) c ON c.doc_id = x.doc_id""",
)
def full_mode(spark, sf_dir):
    docs = sections.structured_documents(Source(spark, sf_dir).spans, "full")
    return docs.select("doc_id", "mode", F.md5("structured_text.full_text").alias("text_md5"), "structured_text.page_count", _contents(F.col("structured_text.sections")).alias("contents_md5"))


@query(
    "scanned_documents",
    sql=BLOCKS + "SELECT doc_id, count(*) FILTER (WHERE n < 20 AND t <> '') = 0 AS is_scanned FROM s GROUP BY doc_id",
)
def scanned_documents(spark, sf_dir):
    return sections.scanned_documents(Source(spark, sf_dir).spans)


HEADER_SQL = "CASE doc_id % 6 " + " ".join(f"WHEN {i} THEN '{h}'" for i, h in enumerate(sections.REFERENCE_HEADERS)) + " END"


def _reference_text(documents):
    """Each text, a header, and the text's own lines as numbered entries."""
    header = F.expr(HEADER_SQL)
    entries = F.array_join(
        F.transform(
            F.split("text", "\n"),
            lambda x, i: F.concat(F.when(i % 3 == 0, F.concat(F.lit("["), i.cast("string"), F.lit("] "))).when(i % 3 == 1, F.concat(F.lit("("), i.cast("string"), F.lit(") "))).otherwise(F.concat(i.cast("string"), F.lit(". "))), x),
        ),
        "\n",
    )
    tail = F.when(header.isNotNull(), F.concat(F.lit("\n  "), header, F.lit(" \n\n"), entries)).otherwise(F.lit(""))
    return documents.select("doc_id", F.concat("text", tail).alias("full_text"))


@query(
    "references_split",
    sql=f"""
WITH l AS (SELECT doc_id, {HEADER_SQL} AS h, unnest(range(0, len(string_split(text, chr(10))))) AS n, unnest(string_split(text, chr(10))) AS row FROM documents)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS INT) AS pos, e AS reference FROM (
 SELECT doc_id, n, trim(CASE WHEN n = 0 THEN '[0] ' || row ELSE row END, {WS}) AS e FROM l WHERE h IS NOT NULL) x WHERE e <> ''""",
)
def references_split(spark, sf_dir):
    texts = _reference_text(Source(spark, sf_dir).documents)
    return texts.select("doc_id", F.posexplode(sections.references_of(F.col("full_text"))).alias("pos", "reference"))


# Sections of the fixture's JSON: line i is a section titled S<i % 4>; the last line of a title wins.
PARSED = """
WITH l AS (SELECT stem, parser, state, n_chars, text AS lead, unnest(range(0, len(string_split(text, chr(10))))) AS n, unnest(string_split(text, chr(10))) AS row FROM extractions),
t AS (SELECT stem, parser, 'S' || (n % 4) AS title, min(n) AS p, arg_max(row, n) AS c FROM l WHERE state NOT IN ('broken', 'empty') GROUP BY stem, parser, title),
x AS (SELECT stem, parser, count(*) AS n_sections, sum(length(c)) AS chars, max(length(c)) AS longest, string_agg(title || chr(10) || c, chr(10) || chr(10) ORDER BY p) AS full_text,
 string_agg('## ' || title || chr(10) || chr(10) || c, chr(10) || chr(10) ORDER BY p) AS markdown, '{' || string_agg('"' || title || '": ' || to_json(c), ', ' ORDER BY p) || '}' AS js FROM t GROUP BY stem, parser)
"""


@query(
    "sections_last_wins", "extractions",
    sql=PARSED + """SELECT e.stem, e.parser, CASE WHEN e.parser = 'grobid' AND e.state <> 'broken' AND e.n_chars % 3 <> 0 THEN md5(e.text) END AS abstract_md5,
 x.n_sections, md5(x.full_text) AS text_md5, md5(x.markdown) AS markdown_md5, md5(x.js) AS json_md5, e.state = 'broken' AS unreadable FROM extractions e LEFT JOIN x ON e.stem = x.stem AND e.parser = x.parser""",
)
def sections_last_wins(spark, sf_dir):
    parsed = sections.parsed_sections(Source(spark, sf_dir).bodies)
    s = F.col("sections")
    return parsed.select(
        "stem", "parser", F.md5("abstract").alias("abstract_md5"), F.array_size(s).cast("long").alias("n_sections"), F.md5(sections.sections_text(s)).alias("text_md5"),
        F.md5(sections.sections_markdown(s)).alias("markdown_md5"), F.md5(sections.sections_json(s)).alias("json_md5"), "unreadable",
    )


@query(
    "section_stats", "extractions",
    sql=PARSED + """SELECT e.stem, e.parser, coalesce(x.n_sections, 0) AS n_sections, CAST(coalesce(x.chars, 0) AS BIGINT) AS total_chars, CAST(coalesce(x.longest, 0) AS BIGINT) AS longest_section
FROM extractions e LEFT JOIN x ON e.stem = x.stem AND e.parser = x.parser""",
)
def section_stats(spark, sf_dir):
    return sections.section_statistics(sections.parsed_sections(Source(spark, sf_dir).bodies))


@query(
    "extraction_fallback", "extractions",
    sql=PARSED + f"""SELECT e.stem, CASE WHEN x.stem IS NOT NULL THEN 'grobid' ELSE 'fallback_pypdf' END AS extraction_method, coalesce(x.n_sections, 1) AS n_sections,
 md5(coalesce(x.full_text, 'Full Text (Fallback Extraction)' || chr(10) || trim(e.text, {WS}))) AS text_md5
FROM (SELECT DISTINCT stem, text FROM extractions) e LEFT JOIN (SELECT * FROM x WHERE parser = 'grobid') x ON e.stem = x.stem WHERE x.stem IS NOT NULL OR trim(e.text, {WS}) <> ''""",
)
def extraction_fallback(spark, sf_dir):
    s = Source(spark, sf_dir)
    structured = sections.parsed_sections(s.bodies.filter("parser = 'grobid'"))
    raw = s.extractions.groupBy("stem").agg(F.max("text").alias("text"))
    return sections.with_fallback(structured, raw).select(
        "stem", "extraction_method", F.size("sections").cast("long").alias("n_sections"), F.md5(sections.sections_text(F.col("sections"))).alias("text_md5")
    )


@query(
    "keywords",
    sql="SELECT doc_id, CAST(len(string_split(text, ',')) AS INT) AS n, string_split(text, ',')[1] AS first FROM documents WHERE text <> ''",
)
def keywords(spark, sf_dir):
    docs = Source(spark, sf_dir).documents.filter("text <> ''")
    found = sections.keywords_of(F.col("text"))
    return docs.select("doc_id", F.size(found).alias("n"), F.get(found, F.lit(0)).alias("first"))


# -- provider payloads, built from the texts' own numbers --------------------------------

# Payloads carry digests and lines of the texts, so every text counts.
URL = "'https://repo.example.org/' || md5(text)"


def _urls(documents):
    return documents.withColumn("u", F.concat(F.lit("https://repo.example.org/"), F.md5("text"))).withColumn("k", F.col("n_chars") % 7)


@query(
    "best_location",
    sql=f"""SELECT doc_id, CASE n_chars % 7 WHEN 0 THEN {URL} || '/best.pdf' WHEN 1 THEN {URL} || '/p.pdf' WHEN 2 THEN {URL} || '/landing' WHEN 3 THEN {URL} || '/second.pdf'
 WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE {URL} || '/only.pdf' END AS url, CASE WHEN n_chars % 7 = 0 THEN {URL} || '/best.pdf' END AS oa_url FROM documents""",
)
def best_location(spark, sf_dir):
    docs = _urls(Source(spark, sf_dir).documents)
    u = F.col("u")
    shapes = {
        0: ['{"is_oa": true, "best_oa_location": {"url_for_pdf": "', u, '/best.pdf"}, "oa_locations": [{"url": "x"}]}'],
        1: ['{"is_oa": true, "best_oa_location": {"url_for_pdf": "", "pdf_url": "', u, '/p.pdf"}}'],
        2: ['{"is_oa": true, "best_oa_location": {"url": "', u, '/landing"}, "oa_locations": [{"url_for_pdf": "y"}]}'],
        3: ['{"is_oa": false, "best_oa_location": null, "oa_locations": [{"url": null}, {"url_for_pdf": "', u, '/second.pdf"}]}'],
        4: ['{"is_oa": true, "oa_locations": [null, {"url": "', u, '"}]}'],
        5: ['{"is_oa": true, "best'],
    }
    payload = None
    for k, parts in shapes.items():
        text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
        payload = F.when(F.col("k") == k, text) if payload is None else payload.when(F.col("k") == k, text)
    payload = payload.otherwise(F.concat(F.lit('{"oa_locations": [{"pdf_url": "'), u, F.lit('/only.pdf"}]}')))
    rows = docs.select("doc_id", payload.alias("payload"))
    return rows.select("doc_id", P.unpaywall_pdf_url(F.col("payload")).alias("url"), P.open_access_url(F.col("payload")).alias("oa_url"))


@query(
    "oa_found_counts",
    sql="SELECT count(*) FILTER (WHERE n_chars % 2 = 0 AND doc_id % 3 <> 0) AS found_oa, count(*) FILTER (WHERE NOT (n_chars % 2 = 0 AND doc_id % 3 <> 0)) AS no_oa FROM documents",
)
def oa_found_counts(spark, sf_dir):
    docs = _urls(Source(spark, sf_dir).documents)
    payload = F.concat(
        F.lit('{"is_oa": '), (F.col("n_chars") % 2 == 0).cast("string"), F.lit(', "best_oa_location": '),
        F.when(F.col("doc_id") % 3 == 0, "null").otherwise(F.concat(F.lit('{"url_for_pdf": "'), "u", F.lit('"}'))), F.lit("}"),
    )
    url = P.open_access_url(F.col("payload"))
    return docs.select(payload.alias("payload")).agg(F.count_if(url.isNotNull()).alias("found_oa"), F.count_if(url.isNull()).alias("no_oa"))


@query(
    "openalex_url",
    sql=f"""SELECT doc_id, CASE n_chars % 7 WHEN 0 THEN {URL} || '/a' WHEN 1 THEN {URL} || '/b' WHEN 2 THEN {URL} || '/c' WHEN 3 THEN {URL} || '/d' END AS url FROM documents""",
)
def openalex_url(spark, sf_dir):
    docs = _urls(Source(spark, sf_dir).documents)
    u, k = F.col("u"), F.col("k")
    payload = (
        F.when(k == 0, F.concat(F.lit('{"primary_location": {"pdf_url": "'), u, F.lit('/a", "source": {"pdf_url": "z"}}}')))
        .when(k == 1, F.concat(F.lit('{"primary_location": {"pdf_url": null, "source": {"pdf_url": "'), u, F.lit('/b"}}}')))
        .when(k == 2, F.concat(F.lit('{"primary_location": null, "locations": [{"pdf_url": ""}, {"source": {"pdf_url": "'), u, F.lit('/c"}}], "oa_locations": [{"pdf_url": "z"}]}')))
        .when(k == 3, F.concat(F.lit('{"locations": [], "oa_locations": [{"pdf_url": "'), u, F.lit('/d"}]}')))
        .otherwise('{"primary_location": {}, "locations": [{"pdf_url": null}]}')
    )
    return docs.select("doc_id", payload.alias("payload")).select("doc_id", P.openalex_pdf_url(F.col("payload")).alias("url"))


@query(
    "semantic_scholar_record",
    sql=f"""
WITH t AS (SELECT doc_id, n_chars, split_part(text, chr(10), 1) AS title, nullif({MIRRORS}, '') || CAST(doc_id AS VARCHAR) || '.pdf' AS u FROM documents)
SELECT doc_id, u AS raw_url, CASE WHEN u LIKE 'https://doi.org/%' OR u LIKE 'http://dx.doi.org/%' THEN NULL ELSE u END AS pdf_url, n_chars % 2 = 0 AS open_access, CASE WHEN n_chars % 3 <> 0 THEN title ELSE '' END AS title, CAST(2000 + n_chars % 20 AS INT) AS year, 'V' AS venue, {LABEL_SQL} AS pdf_source FROM t""",
)
def semantic_scholar_record(spark, sf_dir):
    root = F.nullif(F.expr(MIRRORS), F.lit(""))
    docs = Source(spark, sf_dir).documents.withColumn("u", F.concat(root, F.col("doc_id").cast("string"), F.lit(".pdf")))
    payload = F.concat(
        F.lit('{"venue": "V", '), F.when(F.col("n_chars") % 3 != 0, F.concat(F.regexp_extract(F.to_json(F.struct(fixtures.first_line(F.col("text")).alias("title"))), r"(?s)^\{(.*)\}$", 1), F.lit(", "))).otherwise(""),
        F.lit('"year": '), (2000 + F.col("n_chars") % 20).cast("string"), F.when(F.col("n_chars") % 2 == 0, ', "isOpenAccess": true').otherwise(""),
        F.lit(', "openAccessPdf": '), F.coalesce(F.concat(F.lit('{"url": "'), F.col("u"), F.lit('"}')), F.lit("null")), F.lit("}"),
    )
    rows = docs.select("doc_id", payload.alias("payload"))
    return rows.select("doc_id", P.semantic_scholar_pdf_url(F.col("payload")).alias("raw_url"), F.inline(F.array(P.semantic_scholar_record(F.col("payload")))))


@query(
    "europe_pmc_url",
    sql="""SELECT doc_id, CASE n_chars % 4 WHEN 0 THEN 'https://europepmc.org/articles/PMC' || doc_id || '?pdf=render' WHEN 1 THEN 'https://europepmc.org/articles/PMC' || doc_id WHEN 2 THEN 'https://other.org/' || md5(text) END AS url FROM documents""",
)
def europe_pmc_url(spark, sf_dir):
    ident, k = F.col("doc_id").cast("string"), F.col("n_chars") % 4
    url = F.when(k < 2, F.concat(F.lit("https://europepmc.org/articles/PMC"), ident)).otherwise(F.concat(F.lit("https://other.org/"), F.md5("text")))
    payload = F.concat(
        F.lit('{"resultList": {"result": [{'), F.when(k == 0, F.concat(F.lit('"pmcid": "PMC'), ident, F.lit('", '))).otherwise(""),
        F.lit('"fullTextUrlList": {"fullTextUrl": [{"availability": "Subscription required", "url": "s"}, {"availability": "'),
        F.when(k == 3, "Open access").otherwise("Free"), F.lit('", "url": "'), url, F.lit('"}]}}]}}'),
    )
    return Source(spark, sf_dir).documents.select("doc_id", payload.alias("payload")).select("doc_id", P.europe_pmc_pdf_url(F.col("payload")).alias("url"))


@query(
    "pmid_to_doi", "papers",
    sql="SELECT pmid, CASE WHEN pmid IS NOT NULL THEN doi END AS doi FROM papers",
)
def pmid_to_doi(spark, sf_dir):
    ids = F.concat(
        F.lit('[{"idtype": "pubmed", "value": "1"}'), F.coalesce(F.concat(F.lit(', {"idtype": "doi", "value": "'), "doi", F.lit('"}, {"idtype": "doi", "value": "later"}')), F.lit("")), F.lit("]"),
    )
    payload = F.concat(F.lit('{"result": {"uids": ["'), "pmid", F.lit('"], "'), "pmid", F.lit('": {"articleids": '), ids, F.lit("}}}"))
    rows = Source(spark, sf_dir).papers.select("pmid", payload.alias("payload"))
    return rows.select("pmid", P.doi_of_pmid(F.col("pmid"), F.col("payload")).alias("doi"))


@query(
    "title_to_doi",
    sql=f"SELECT doc_id, CASE WHEN n_chars % 70 > 35 THEN {fixtures.DOI} END AS doi FROM documents",
)
def title_to_doi(spark, sf_dir):
    docs = Source(spark, sf_dir).documents.select("doc_id", "n_chars", F.expr(fixtures.DOI).alias("d"))
    payload = F.concat(
        F.lit('{"message": {"items": [{"DOI": "'), "d", F.lit('", "score": '), (F.col("n_chars") % 70).cast("string"), F.lit('}, {"DOI": "10.1/other", "score": 99}]}}')
    )
    return docs.select("doc_id", payload.alias("payload")).select("doc_id", P.doi_of_title(F.col("payload")).alias("doi"))


@query(
    "arxiv_search_url",
    sql="SELECT doc_id, CASE WHEN n_chars % 3 <> 0 THEN 'https://arxiv.org/pdf/24' || doc_id || 'v1.pdf' END AS url FROM documents",
)
def arxiv_search_url(spark, sf_dir):
    entry = F.concat(F.lit("<entry><id>http://arxiv.org/abs/24"), F.col("doc_id").cast("string"), F.lit("v1</id></entry>"))
    feed = F.concat(F.lit("<feed><id>http://arxiv.org/api/x</id>"), F.when(F.col("n_chars") % 3 != 0, entry).otherwise(""), F.lit("</feed>"))
    return Source(spark, sf_dir).documents.select("doc_id", P.arxiv_search_pdf_url(feed).alias("url"))


# -- TEI -------------------------------------------------------------------------------

OK_TEI = "n_chars % 19 <> 0"


@query(
    "tei_metadata",
    sql=f"""SELECT doc_id, NOT ({OK_TEI}) AS malformed, CASE WHEN {OK_TEI} THEN '10.1/' || doc_id END AS doi, CASE WHEN {OK_TEI} THEN trim(split_part(text, chr(10), 1), {WS}) END AS title,
 CASE WHEN {OK_TEI} THEN 'one two' END AS abstract, CASE WHEN {OK_TEI} THEN 'J' END AS journal, CASE WHEN {OK_TEI} THEN CAST(doc_id % 40 AS VARCHAR) END AS volume, CASE WHEN {OK_TEI} THEN '2019' END AS year,
 CASE WHEN {OK_TEI} THEN 'k1' ELSE '' END AS keywords,
 CASE WHEN {OK_TEI} THEN 'A B' || doc_id || '|Lab|b@x.org' || repeat(';R Q' || doc_id || '||', CASE n_chars % 3 WHEN 0 THEN 1 WHEN 1 THEN 1 ELSE 2 END) ELSE '' END AS authors FROM documents""",
)
def tei_metadata(spark, sf_dir):
    meta = tei.metadata(fixtures.tei_documents(spark, sf_dir))

    def part(a, name):
        return F.coalesce(a[name], F.lit(""))

    authors = F.array_join(
        F.transform("authors", lambda a: F.concat(part(a, "name"), F.lit("|"), part(a, "affiliation"), F.lit("|"), part(a, "email"))), ";"
    )
    return meta.select(
        "doc_id", F.col("error").isNotNull().alias("malformed"), "doi", "title", "abstract", "journal", "volume", "year", F.array_join("keywords", ",").alias("keywords"), authors.alias("authors")
    )


@query(
    "tei_sections",
    sql=f"""
WITH l AS (SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS n, unnest(string_split(text, chr(10))) AS row FROM documents WHERE {OK_TEI})
SELECT doc_id, CAST(n AS INT) AS pos, CASE WHEN n % 3 <> 0 THEN 'S' || n ELSE 'Unnamed Section' END AS title, trim(row, {WS}) || chr(10) || chr(10) || 'a b c' AS content FROM l""",
)
def tei_sections(spark, sf_dir):
    return tei.sections(fixtures.tei_documents(spark, sf_dir))


@query(
    "tei_references",
    sql=f"""
WITH l AS (SELECT doc_id, unnest(range(1, n_chars % 3 + 2)) AS k FROM documents WHERE {OK_TEI})
SELECT doc_id, CAST(k - 1 AS INT) AS pos, CASE WHEN k <> 2 THEN 'T' || k END AS title, CASE WHEN k <> 2 THEN 'R Q' || doc_id END AS authors, CASE WHEN k <> 2 THEN '2011' END AS year, CASE WHEN k = 2 THEN 'raw ' || doc_id END AS raw FROM l""",
)
def tei_references(spark, sf_dir):
    refs = tei.references(fixtures.tei_documents(spark, sf_dir))
    return refs.select("doc_id", "pos", "title", F.array_join("authors", ";").alias("authors"), "year", "raw")


# -- batch extraction and logs ------------------------------------------------------------


def _word_counter(stem: str, content: bytes) -> str | None:
    import json

    text = content.decode("utf-8")
    if not text.isascii():
        raise ValueError("not plain text")
    return json.dumps({"stem": stem, "words": len(text.split())}) if len(text) >= 200 else None


@query(
    "batch_extraction", "extractions", "papers",
    sql=f"""SELECT status, count(*) AS files FROM (SELECT CASE WHEN strlen(text) <> length(text) THEN 'error' WHEN length(text) >= 200 THEN 'success' ELSE 'failed' END AS status
 FROM documents d WHERE {fixtures.STEM} NOT IN (SELECT stem FROM extractions WHERE parser = 'pymupdf')) x GROUP BY status""",
)
def batch_extraction(spark, sf_dir):
    return sections.extraction_totals(sections.run_extractor(_pending_files(spark, sf_dir), _word_counter))


def _pending_files(spark, sf_dir):
    s = Source(spark, sf_dir)
    files = s.documents.select(F.expr(fixtures.STEM).alias("stem"), F.encode("text", "UTF-8").alias("content"))
    return files.join(s.presence.filter("parser = 'pymupdf'").select("stem"), "stem", "left_anti")


PENDING_SQL = f"FROM (SELECT {fixtures.STEM} AS stem, text FROM documents) d WHERE stem NOT IN (SELECT stem FROM extractions WHERE parser = 'pymupdf')"


@query(
    "batch_extraction_files", "extractions", "papers",
    sql=f"""SELECT stem, status, replace(stem, '_', '/') AS doi, CASE WHEN status = 'error' THEN 'ValueError: not plain text' END AS error FROM (
 SELECT stem, CASE WHEN strlen(text) <> length(text) THEN 'error' WHEN length(text) >= 200 THEN 'success' ELSE 'failed' END AS status {PENDING_SQL}) x""",
)
def batch_extraction_files(spark, sf_dir):
    return sections.run_extractor(_pending_files(spark, sf_dir), _word_counter).select("stem", "status", "doi", "error")


@query("batch_extraction_dry_run", "extractions", "papers", sql=f"SELECT stem {PENDING_SQL} AND stem IN (SELECT DISTINCT stem {PENDING_SQL} ORDER BY stem LIMIT 20)")
def batch_extraction_dry_run(spark, sf_dir):
    return sections.run_extractor(_pending_files(spark, sf_dir), _word_counter, limit=20, dry_run=True)


def _line_sections(frame, mode):
    """Plug-in over batches: text lines become sections; anything but plain ASCII is refused."""
    out = []
    for stem, content in zip(frame["stem"], frame["content"]):
        if any(b > 127 for b in content):
            raise ValueError("not plain text")
        text = content.decode()
        lines = [line for line in text.split("\n") if line]
        parts = {"text": text} if mode == "simple" else {"sections": lines} if mode == "structured" else {"text": text, "sections": lines}
        out.append((stem, json.dumps({"mode": mode, **parts}) if len(text) >= 200 else None))
    return pd.DataFrame(out, columns=["stem", "body"])


FILE_STATUS = "CASE WHEN strlen(text) <> length(text) THEN 'error' WHEN length(text) >= 200 THEN 'success' ELSE 'failed' END"


@query(
    "extraction_resumed",
    sql=f"""SELECT {fixtures.STEM} AS stem, 'full' AS mode, {FILE_STATUS} AS status, replace({fixtures.STEM}, '_', '/') AS doi,
 CASE WHEN {FILE_STATUS} = 'error' THEN 'ValueError: not plain text' END AS error, CASE WHEN {FILE_STATUS} = 'success' THEN md5(text) END AS text_md5,
 CASE WHEN {FILE_STATUS} = 'success' THEN len(list_filter(string_split(text, chr(10)), lambda x: x <> '')) END AS lines FROM documents WHERE text IS NOT NULL""",
)
def extraction_resumed(spark, sf_dir):
    """Files extracted in batches: the first run stops after one, a second one goes on with the rest."""
    root = scratch_folder(spark)
    docs = Source(spark, sf_dir).documents.filter("text IS NOT NULL")
    files.write_files(docs.select(F.concat(F.expr(fixtures.STEM), F.lit(".pdf")).alias("name"), "text"), f"{root}/in", body="text")
    listed = files.file_edges(spark, f"{root}/in", pattern="*.pdf", head=0, tail=0)
    extraction.plan(listed.select(F.regexp_replace("name", r"\.pdf$", "").alias("stem"), "path"), f"{root}/run", max(1, docs.count() // 3))
    extraction.run_batches(spark, _line_sections, f"{root}/run", "full", stop_after=1)
    extraction.run_batches(spark, _line_sections, f"{root}/run", "full")
    body = F.from_json("body", "text string, sections array<string>")
    found = extraction.results(spark, f"{root}/run").withColumn("parsed", body)
    return found.select("stem", "mode", "status", "doi", "error", F.md5("parsed.text").alias("text_md5"), F.array_size("parsed.sections").cast("long").alias("lines"))


@query("log_blocks", "run_log", sql="SELECT doi, ts, result, parser, file_ord, pos FROM run_log")
def log_blocks(spark, sf_dir):
    return logs.parse_blocks(fixtures.run_log_blocks(spark, sf_dir))


@query(
    "latest_log_entry", "run_log",
    sql="SELECT doi, result, parser, ts FROM (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY ts DESC, file_ord, pos) AS rn FROM run_log) x WHERE rn = 1",
)
def latest_log_entry(spark, sf_dir):
    return merge.latest_log_entry(logs.parse_blocks(fixtures.run_log_blocks(spark, sf_dir)))


@query(
    "file_metadata_doi", "pdfs",
    sql="SELECT dir, stem, replace(stem, '_', '/') AS doi FROM pdfs",
)
def file_metadata_doi(spark, sf_dir):
    return Source(spark, sf_dir).pdfs.select("dir", "stem", metadata_doi(F.col("stem")).alias("doi"))
