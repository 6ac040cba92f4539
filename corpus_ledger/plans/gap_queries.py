"""Work list, identifiers, URLs and gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..functions import identifiers as I
from ..functions import urls as U
from ..operators import gaps, inventory
from ..session import scratch_folder
from ..sources import lists
from .registry import Source, query

BLANK = "({0} IS NULL OR {0} = '')"
NO_ABSTRACT = BLANK.format("abstract")
NO_TEXT = BLANK.format("full_text")
NO_SECTIONS = BLANK.format("full_text_sections")
HAS_DOI = "(doi IS NOT NULL AND doi <> '')"
WORTH = (
    "SELECT DISTINCT doi FROM evaluations WHERE result IN ('valid','doubted') "
    "OR (result = 'not_valid' AND coalesce(confidence_score, 999) <= 7)"
)
# Raw identifiers are stripped of the whole white-space set before anything else.
WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(
    "work_list", "papers", "evaluations",
    sql=f"""SELECT DISTINCT doi FROM papers WHERE {HAS_DOI} AND ({NO_ABSTRACT} OR {NO_SECTIONS})
AND doi IN ({WORTH}) ORDER BY doi""",
)
def work_list(spark, sf_dir):
    s = Source(spark, sf_dir)
    return gaps.work_list(s.papers, s.evaluations)


@query(
    "work_list_limited", "papers", "evaluations",
    sql=f"""SELECT DISTINCT doi FROM papers WHERE {HAS_DOI} AND ({NO_ABSTRACT} OR {NO_SECTIONS})
AND doi IN ({WORTH}) ORDER BY doi LIMIT 20""",
)
def work_list_limited(spark, sf_dir):
    s = Source(spark, sf_dir)
    return gaps.work_list(s.papers, s.evaluations, limit=20)


@query(
    "normalize_ids", "id_list",
    sql=f"""
WITH t AS (SELECT pos, identifier, trim(identifier, {WS}) AS v FROM id_list),
p AS (SELECT *, trim(regexp_replace(v, '^(doi:|doi\\.org/|dx\\.doi\\.org/|http://dx\\.doi\\.org/|https://dx\\.doi\\.org/|http://doi\\.org/|https://doi\\.org/|https://www\\.doi\\.org/|http://www\\.doi\\.org/)', '', 'i'), {WS}) AS n,
  CASE WHEN v LIKE '/j/%.xml' AND split_part(v, '/', -2) || '.xml' = split_part(v, '/', -1) AND regexp_full_match(split_part(v, '/', -2), '[a-z0-9-]+')
       THEN '10.1515/' || split_part(v, '/', -2) END AS path_doi FROM t),
d AS (SELECT pos, identifier, v, CASE WHEN coalesce(path_doi, n) LIKE '10.%' AND contains(coalesce(path_doi, n), '/') THEN coalesce(path_doi, n) END AS doi,
  rtrim(split_part(n, '?', 1), '.,;: ') AS s FROM p)
SELECT pos, identifier, doi, CASE WHEN s LIKE '10.%' THEN s END AS strict_doi,
 coalesce(regexp_full_match(upper(CASE WHEN s LIKE '10.%' THEN s END), '10\\.[0-9]{{4,9}}/[!-~]+'), false) AS is_valid,
 replace(doi, '/', '_') AS stem, regexp_replace(doi, '[^A-Za-z0-9_.-]', '_', 'g') AS safe_name FROM d""",
)
def normalize_ids(spark, sf_dir):
    raw = F.col("identifier")
    doi = I.normalize_doi(raw)
    return Source(spark, sf_dir).id_list.select(
        "pos", "identifier", doi.alias("doi"), I.normalize_doi(raw, "strict").alias("strict_doi"),
        I.is_valid_doi(raw).alias("is_valid"), I.stem_of(doi).alias("stem"), I.safe_file_name(doi).alias("safe_name"),
    )


@query(
    "detect_type", "id_list",
    sql=f"""
WITH t AS (SELECT pos, identifier, trim(identifier, {WS}) AS v, lower(trim(identifier, {WS})) AS l FROM id_list),
m AS (SELECT *, trim(CASE WHEN l LIKE 'pmid:%' OR l LIKE 'pmid %' THEN substr(v, 6) ELSE v END, {WS}) AS n FROM t)
SELECT pos, CASE WHEN regexp_full_match(v, '[0-9]{{6,}}') THEN 'pmid' WHEN l LIKE 'pmid:%' OR l LIKE 'pmid %' THEN 'pmid'
 WHEN contains(l, '10.') OR contains(l, 'doi:') OR contains(l, 'doi.org/') THEN 'doi' ELSE 'title' END AS kind,
 CASE WHEN regexp_full_match(n, '[0-9]+') THEN n END AS pmid,
 regexp_full_match(n, '[0-9]{{6,}}') AS is_pmid,
 trim(regexp_replace(v, '[[:space:]]+', ' ', 'g')) AS title FROM m""",
)
def detect_type(spark, sf_dir):
    raw = F.col("identifier")
    return Source(spark, sf_dir).id_list.select(
        "pos", I.identifier_type(raw).alias("kind"), I.normalize_pmid(raw).alias("pmid"),
        I.is_valid_pmid(raw).alias("is_pmid"), I.clean_title(raw).alias("title"),
    )


@query(
    "identifier_set", "id_list",
    sql=f"""SELECT DISTINCT identifier FROM (SELECT trim(replace(identifier, chr(10), ' '), {WS}) AS identifier FROM id_list) x
WHERE identifier <> '' AND identifier NOT LIKE '#%'""",
)
def identifier_set(spark, sf_dir):
    # Written as a history list with comments and read back; a line break in an identifier becomes a space.
    path = f"{scratch_folder(spark)}/list"
    lines = Source(spark, sf_dir).id_list.select(F.replace("identifier", F.lit("\n"), F.lit(" ")).alias("value")).unionByName(spark.sql("SELECT '# a comment' AS value"))
    lines.write.text(path)
    return lists.read_identifier_set(spark, path, f"{path}-missing", comments=True).select(F.col("doi").alias("identifier"))


@query(
    "best_identifier", "papers",
    sql="SELECT pmid, coalesce(nullif(doi, ''), nullif(title, '')) AS identifier FROM papers",
)
def best_identifier(spark, sf_dir):
    return gaps.best_identifiers(Source(spark, sf_dir).papers)


@query(
    "url_canonical",
    sql="""SELECT page_id, split_part(url, '#', 1) AS url, 'https://' || split_part(substr(url, position('://' IN url) + 3), '#', 1) AS from_scheme_relative,
 'https://www.' || split_part(substr(url, position('://' IN url) + 3), '#', 1) AS from_www,
 split_part(url, '/', 1) || '//' || split_part(url, '/', 3) || '/a/c.pdf?d=1' AS from_relative
FROM pages""",
)
def url_canonical(spark, sf_dir):
    pages = Source(spark, sf_dir).pages
    url = F.col("url")
    bare = F.regexp_replace(url, "^[a-z]+://", "")
    return pages.select(
        "page_id", U.canonical_url(url).alias("url"),
        U.canonical_url(F.concat(F.lit("//"), bare)).alias("from_scheme_relative"),
        U.canonical_url(F.concat(F.lit("www."), bare)).alias("from_www"),
        U.canonical_url(F.lit("/a/b/../c.pdf?d=1#x"), url).alias("from_relative"),
    )


LABEL_SQL = """CASE WHEN u IS NULL OR u = '' OR u LIKE 'https://doi.org/%' OR u LIKE 'http://dx.doi.org/%' THEN NULL
 WHEN contains(u, 'arxiv.org') THEN 'arXiv' WHEN contains(u, 'biorxiv.org') OR contains(u, 'medrxiv.org') THEN 'bioRxiv/medRxiv'
 WHEN contains(u, 'ncbi.nlm.nih.gov/pmc') THEN 'PubMed Central' WHEN contains(u, 'europepmc.org') THEN 'Europe PMC'
 WHEN contains(u, 'researchgate.net') THEN 'ResearchGate' ELSE 'Other repository' END"""
MIRRORS = (
    "CASE doc_id % 9 WHEN 0 THEN 'https://arxiv.org/pdf/' WHEN 1 THEN 'https://www.medrxiv.org/content/' "
    "WHEN 2 THEN 'https://www.ncbi.nlm.nih.gov/pmc/' WHEN 3 THEN 'https://europepmc.org/articles/' "
    "WHEN 4 THEN 'https://www.researchgate.net/' WHEN 5 THEN 'https://www.sciencedirect.com/science/article/pii/S' "
    "WHEN 6 THEN 'https://doi.org/' WHEN 7 THEN 'http://dx.doi.org/' ELSE '' END"
)


@query(
    "host_label",
    sql=f"""
WITH t AS (SELECT doc_id, nullif({MIRRORS}, '') || CAST(doc_id AS VARCHAR) || '.pdf' AS u FROM documents)
SELECT doc_id, u AS url, {LABEL_SQL} AS label, coalesce(contains(u, '//www.sciencedirect.com'), false) AS is_publisher,
 nullif(regexp_extract(u, '/pii/([A-Za-z0-9]+)', 1), '') AS pii FROM t""",
)
def host_label(spark, sf_dir):
    root = F.nullif(F.expr(MIRRORS), F.lit(""))
    docs = Source(spark, sf_dir).documents.select("doc_id", F.concat(root, F.col("doc_id").cast("string"), F.lit(".pdf")).alias("url"))
    url = F.col("url")
    return docs.select(
        "doc_id", "url", U.repository_label(url).alias("label"), U.is_publisher_host(url).alias("is_publisher"), U.pii_of_url(url).alias("pii")
    )


@query(
    "first_link",
    sql="""
WITH t AS (SELECT page_id, url, html || '<a href="https://files.example.org/' || CAST(page_id AS VARCHAR) || '.PDF">x</a> PII: S0' || CAST(page_id AS VARCHAR) || ' .' AS html FROM pages)
SELECT page_id, nullif(regexp_extract(html, 'https://[^\\s''"]+\\.pdf', 0, 'i'), '') AS link,
 nullif(regexp_extract(html, 'PII:\\s*([A-Z0-9]+)', 1), '') AS pii FROM t""",
)
def first_link(spark, sf_dir):
    ident = F.col("page_id").cast("string")
    tail = F.concat(F.lit('<a href="https://files.example.org/'), ident, F.lit('.PDF">x</a> PII: S0'), ident, F.lit(" ."))
    pages = Source(spark, sf_dir).pages.withColumn("html", F.concat("html", tail))
    return pages.select(
        "page_id", U.first_pdf_link(F.col("html")).alias("link"), U.pii_of_page(F.col("url"), F.col("html")).alias("pii")
    )


@query(
    "candidate_urls", "papers",
    sql="""
WITH t AS (SELECT pmid, CAST(pmid AS BIGINT) % 3 AS k,
  CASE CAST(pmid AS BIGINT) % 3 WHEN 0 THEN '10.48550/arxiv.' || pmid WHEN 1 THEN '10.1101/' || pmid ELSE doi END AS d FROM papers)
SELECT pmid, d AS doi, u AS url FROM (
 SELECT pmid, d, 'https://arxiv.org/pdf/' || pmid || '.pdf' AS u FROM t WHERE k = 0
 UNION ALL SELECT pmid, d, 'https://www.biorxiv.org/content/' || d || 'v1.full.pdf' FROM t WHERE contains(d, '10.1101/')
 UNION ALL SELECT pmid, d, 'https://www.sciencedirect.com/science/article/pii/S' || pmid || '/pdfft' FROM t
 UNION ALL SELECT pmid, d, 'https://www.sciencedirect.com/science/article/pii/S' || pmid || '/pdf' FROM t) x WHERE u IS NOT NULL""",
)
def candidate_urls(spark, sf_dir):
    k = F.col("pmid").cast("long") % 3
    doi = (
        F.when(k == 0, F.concat(F.lit("10.48550/arxiv."), "pmid")).when(k == 1, F.concat(F.lit("10.1101/"), "pmid")).otherwise(F.col("doi"))
    )
    rows = Source(spark, sf_dir).papers.select("pmid", doi.alias("doi"), F.concat(F.lit("S"), "pmid").alias("pii"))
    return rows.select("pmid", "doi", F.explode(U.candidate_urls(F.col("doi"), F.col("pii"))).alias("url"))


@query(
    "missing_matrix", "papers",
    sql=f"""SELECT count(*) AS total, count(*) FILTER (WHERE {NO_TEXT}) AS missing_full_text,
 count(*) FILTER (WHERE {NO_ABSTRACT}) AS missing_abstract, count(*) FILTER (WHERE {NO_TEXT} OR {NO_ABSTRACT}) AS missing_either,
 count(*) FILTER (WHERE {NO_TEXT} AND {NO_ABSTRACT}) AS missing_both FROM papers""",
)
def missing_matrix(spark, sf_dir):
    return gaps.missing_matrix(Source(spark, sf_dir).papers)


@query(
    "gap_flags", "papers",
    sql=f"""SELECT pmid, {NO_TEXT} AS missing_text, {NO_ABSTRACT} AS missing_abstract, ({NO_TEXT} AND {NO_SECTIONS}) AS missing_all_text,
 coalesce(trim(abstract, {WS}) <> '', false) AS has_abstract, coalesce(trim(full_text, {WS}) <> '', false) AS has_full_text,
 coalesce(trim(full_text_sections, {WS}) <> '', false) AS has_sections, {BLANK.format('parsing_status')} AS without_status
FROM papers WHERE {NO_TEXT} OR {NO_ABSTRACT}""",
)
def gap_flags(spark, sf_dir):
    rows = gaps.content_flags(Source(spark, sf_dir).papers.filter(gaps.missing_text_or_abstract()))
    return rows.select(
        "pmid", gaps.missing_text().alias("missing_text"), gaps.missing_abstract().alias("missing_abstract"),
        gaps.missing_all_text().alias("missing_all_text"), "has_abstract", "has_full_text", "has_sections", gaps.without_status().alias("without_status"),
    )


@query(
    "needs_update", "papers",
    sql=f"""SELECT doi FROM papers WHERE {HAS_DOI} AND ({NO_ABSTRACT} OR {NO_TEXT} OR {NO_SECTIONS}
 OR (parsing_status IS NOT NULL AND parsing_status <> '' AND NOT contains(lower(parsing_status), 'grobid')))""",
)
def needs_update(spark, sf_dir):
    return gaps.keyed(Source(spark, sf_dir).papers).filter(gaps.needs_update()).select("doi")


OA = (
    f"{HAS_DOI} AND {NO_TEXT} AND {NO_SECTIONS} AND (oa_url IS NULL OR oa_url = '' "
    "OR oa_url ILIKE 'https://doi.org/%' OR oa_url ILIKE 'http://dx.doi.org/%')"
)


@query("needs_oa", "papers", sql=f"SELECT doi, oa_url, year FROM papers WHERE {OA}")
def needs_oa(spark, sf_dir):
    return gaps.keyed(Source(spark, sf_dir).papers).filter(gaps.needs_oa_url()).select("doi", "oa_url", "year")


@query(
    "needs_oa_recent", "papers",
    sql=f"SELECT doi, year FROM papers WHERE {OA} AND year >= '2020' ORDER BY doi LIMIT 50",
)
def needs_oa_recent(spark, sf_dir):
    rows = gaps.keyed(Source(spark, sf_dir).papers).filter(gaps.needs_oa_url("2020")).select("doi", "year")
    return rows.orderBy("doi").limit(50)


@query("no_doi", "papers", sql="SELECT pmid, title FROM papers WHERE doi IS NULL OR doi = ''")
def no_doi(spark, sf_dir):
    return gaps.without_doi(Source(spark, sf_dir).papers).select("pmid", "title")


# The removed list: every DOI the run log knows plus every tracked DOI without a download.
REMOVED = "SELECT doi FROM run_log UNION SELECT doi FROM tracker WHERE downloaded = 'no'"


def _removed(s: Source):
    return s.run_log.select("doi").unionByName(s.tracker.filter("downloaded = 'no'").select("doi")).distinct()


@query(
    "priority_removed", "papers", "evaluations", "run_log", "tracker",
    sql=f"""SELECT doi FROM ({REMOVED}) r WHERE doi NOT IN (SELECT doi FROM papers WHERE {HAS_DOI}
 AND (coalesce(trim(full_text, {WS}) <> '', false) OR coalesce(trim(full_text_sections, {WS}) <> '', false)))
 AND doi IN ({WORTH})""",
)
def priority_removed(spark, sf_dir):
    s = Source(spark, sf_dir)
    return gaps.priority_after_removal(_removed(s), s.papers, s.evaluations)


@query(
    "exclude_lists", "papers", "run_log",
    sql=f"""SELECT doi, title, CASE WHEN {NO_ABSTRACT} AND {NO_SECTIONS} THEN 'missing_both' WHEN {NO_ABSTRACT} THEN 'missing_abstract'
 ELSE 'missing_full_text' END AS gap FROM papers WHERE {HAS_DOI} AND ({NO_ABSTRACT} OR {NO_SECTIONS}) AND doi NOT IN (SELECT doi FROM run_log)""",
)
def exclude_lists(spark, sf_dir):
    s = Source(spark, sf_dir)
    return gaps.new_missing(s.papers, s.run_log)


@query(
    "gap_summary", "papers", "run_log",
    sql=f"""SELECT gap, count(*) AS papers FROM (SELECT CASE WHEN doi IN (SELECT doi FROM run_log) THEN 'already_excluded'
 WHEN {NO_ABSTRACT} AND {NO_SECTIONS} THEN 'missing_both' WHEN {NO_ABSTRACT} THEN 'missing_abstract' ELSE 'missing_full_text' END AS gap
 FROM papers WHERE {HAS_DOI} AND ({NO_ABSTRACT} OR {NO_SECTIONS})) x GROUP BY gap""",
)
def gap_summary(spark, sf_dir):
    s = Source(spark, sf_dir)
    return gaps.gap_summary(s.papers, s.run_log)


@query(
    "presence_diff", "papers", "tracker",
    sql=f"""SELECT coalesce(p.doi, t.doi) AS doi, CASE WHEN t.doi IS NULL THEN 'only_papers' WHEN p.doi IS NULL THEN 'only_tracker' ELSE 'both' END AS presence
FROM (SELECT DISTINCT doi FROM papers WHERE {HAS_DOI}) p FULL JOIN (SELECT DISTINCT doi FROM tracker) t ON p.doi = t.doi""",
)
def presence_diff(spark, sf_dir):
    s = Source(spark, sf_dir)
    return gaps.presence(s.papers, s.tracker)


@query(
    "presence_counts", "papers", "tracker",
    sql=f"""SELECT CASE WHEN t.doi IS NULL THEN 'only_papers' WHEN p.doi IS NULL THEN 'only_tracker' ELSE 'both' END AS presence, count(*) AS dois
FROM (SELECT DISTINCT doi FROM papers WHERE {HAS_DOI}) p FULL JOIN (SELECT DISTINCT doi FROM tracker) t ON p.doi = t.doi GROUP BY 1""",
)
def presence_counts(spark, sf_dir):
    s = Source(spark, sf_dir)
    return gaps.presence_counts(s.papers, s.tracker)


@query(
    "missing_from_tracker", "papers", "tracker",
    sql=f"""SELECT DISTINCT doi, 'not_in_tracker' AS side FROM papers WHERE {HAS_DOI} AND doi NOT IN (SELECT doi FROM tracker)
UNION ALL SELECT DISTINCT doi, 'not_in_papers' AS side FROM tracker WHERE doi NOT IN (SELECT doi FROM papers WHERE {HAS_DOI})""",
)
def missing_from_tracker(spark, sf_dir):
    s = Source(spark, sf_dir)
    papers, tracker = s.papers, s.tracker
    return gaps.not_in_tracker(papers, tracker).withColumn("side", F.lit("not_in_tracker")).unionByName(
        gaps.not_in_papers(papers, tracker).withColumn("side", F.lit("not_in_papers"))
    )


@query(
    "already_complete", "papers", "run_log",
    sql=f"SELECT DISTINCT doi FROM papers WHERE {HAS_DOI} AND doi NOT IN (SELECT doi FROM run_log)",
)
def already_complete(spark, sf_dir):
    s = Source(spark, sf_dir)
    return gaps.already_complete(s.papers, s.run_log)


@query(
    "oa_lookup", "run_log", "papers",
    sql=f"""SELECT r.doi, p.oa_url FROM (SELECT DISTINCT doi FROM run_log) r LEFT JOIN
 (SELECT doi, oa_url FROM papers WHERE {HAS_DOI} AND oa_url IS NOT NULL AND oa_url <> '') p ON r.doi = p.doi""",
)
def oa_lookup(spark, sf_dir):
    s = Source(spark, sf_dir)
    return gaps.oa_lookup(s.run_log, s.papers)


@query(
    "list_status", "tracker", "papers",
    sql=f"""SELECT t.doi,
 CASE WHEN p.doi IS NULL THEN 'NOT FOUND' WHEN {BLANK.format('p.abstract')} THEN 'NO' ELSE 'YES' END AS abstract,
 CASE WHEN p.doi IS NULL THEN 'NOT FOUND' WHEN {BLANK.format('p.full_text')} THEN 'NO' ELSE 'YES' END AS full_text,
 CASE WHEN p.doi IS NULL THEN 'NOT FOUND' WHEN {BLANK.format('p.full_text_sections')} THEN 'NO' ELSE 'YES' END AS sections
FROM (SELECT DISTINCT doi FROM tracker) t LEFT JOIN (SELECT * FROM papers WHERE {HAS_DOI}) p ON t.doi = p.doi""",
)
def list_status(spark, sf_dir):
    s = Source(spark, sf_dir)
    return gaps.list_status(s.tracker, s.papers)


@query(
    "key_union", "papers", "tracker", "extractions", "pdfs",
    sql=f"""SELECT doi FROM papers WHERE {HAS_DOI} UNION SELECT doi FROM tracker UNION SELECT doi FROM {fixtures.with_doi('extractions', 'papers', 'tracker')} e
UNION SELECT doi FROM {fixtures.with_doi('pdfs', 'papers', 'tracker')} p""",
)
def key_union(spark, sf_dir):
    s = Source(spark, sf_dir)
    stems = s.extractions.select("stem").unionByName(s.pdfs.select("stem")).distinct()
    return gaps.key_union(s.papers, s.tracker, inventory.with_doi(stems, s.papers, s.tracker))


@query(
    "key_difference", "papers", "tracker",
    sql=f"""SELECT p.n AS papers, t.n AS tracked, p.n - t.n AS difference FROM
 (SELECT count(*) AS n FROM papers WHERE {HAS_DOI}) p, (SELECT count(*) AS n FROM tracker) t""",
)
def key_difference(spark, sf_dir):
    s = Source(spark, sf_dir)
    return gaps.key_difference(s.papers, s.tracker)


@query(
    "coverage", "papers",
    sql=f"""SELECT *, round(with_abstract * 100.0 / total, 2) AS with_abstract_pct, round(with_sections * 100.0 / total, 2) AS with_sections_pct,
 round(with_status * 100.0 / total, 2) AS with_status_pct FROM (SELECT count(*) AS total, count(*) FILTER (WHERE {HAS_DOI}) AS with_doi,
 count(*) FILTER (WHERE NOT {NO_ABSTRACT}) AS with_abstract, count(*) FILTER (WHERE NOT {NO_TEXT}) AS with_full_text,
 count(*) FILTER (WHERE NOT {NO_SECTIONS}) AS with_sections, count(*) FILTER (WHERE NOT {BLANK.format('parsing_status')}) AS with_status FROM papers) x""",
)
def coverage(spark, sf_dir):
    return gaps.coverage(Source(spark, sf_dir).papers)


@query(
    "oa_content_counts", "papers",
    sql=f"""SELECT count(*) AS total, count(*) FILTER (WHERE c) AS has_content, count(*) FILTER (WHERE u) AS has_oa_url,
 count(*) FILTER (WHERE u AND NOT c) AS oa_without_content FROM (SELECT NOT ({NO_TEXT} AND {NO_SECTIONS}) AS c,
 (oa_url IS NOT NULL AND oa_url <> '') AS u FROM papers WHERE {HAS_DOI}) x""",
)
def oa_content_counts(spark, sf_dir):
    return gaps.oa_content_counts(Source(spark, sf_dir).papers)
