"""Import of extractions, logs and lists into the paper table."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..operators import merge
from ..session import scratch_folder
from ..sources import logs
from .extract_queries import PARSED
from .gap_queries import HAS_DOI, NO_ABSTRACT, NO_SECTIONS, NO_TEXT, WS
from .registry import Source, query

CHOICE = """ch AS (SELECT stem, bool_or(parser = 'grobid') AS hs,
 CASE WHEN bool_or(parser = 'grobid') AND bool_or(parser = 'pymupdf') THEN CASE WHEN bool_or(parser = 'grobid' AND state NOT IN ('broken', 'empty')) THEN 'grobid' ELSE 'pymupdf' END
  WHEN bool_or(parser = 'grobid') THEN 'grobid' ELSE 'pymupdf' END AS chosen FROM extractions GROUP BY stem)"""


def filled(column: str) -> str:
    return f"coalesce(trim({column}, {WS}) <> '', false)"


@query("parser_choice", "extractions", sql=f"WITH {CHOICE} SELECT stem, chosen AS parser, hs AS has_structured FROM ch")
def parser_choice(spark, sf_dir):
    return merge.choose_parser(merge.with_body_flag(Source(spark, sf_dir).bodies))


@query(
    "parser_choice_legacy", "extractions",
    sql="SELECT stem, CASE WHEN bool_or(parser = 'grobid') THEN 'grobid' ELSE 'pymupdf' END AS parser FROM extractions GROUP BY stem",
)
def parser_choice_legacy(spark, sf_dir):
    return merge.choose_parser(merge.with_body_flag(Source(spark, sf_dir).bodies), legacy=True).select("stem", "parser")


IMPORT = PARSED + f""", {CHOICE},
c AS (SELECT e.stem, e.parser, CASE WHEN e.parser = 'grobid' AND e.state <> 'broken' AND e.n_chars % 3 <> 0 THEN e.text END AS na, x.full_text AS nt, x.js
 FROM extractions e LEFT JOIN x ON e.stem = x.stem AND e.parser = x.parser),
d AS (SELECT p.doi, p.parsing_status AS old, {filled('abstract')} AS ha, {filled('full_text')} AS ht, {filled('full_text_sections')} AS hx, ch.stem, ch.hs, ch.chosen,
 (parsing_status IS NOT NULL AND parsing_status <> '' AND NOT contains(lower(parsing_status), 'grobid')) AND ch.hs AS ov FROM papers p JOIN ch ON replace(p.doi, '/', '_') = ch.stem
 WHERE {HAS_DOI.replace('doi', 'p.doi')} AND ({NO_ABSTRACT} OR {NO_TEXT} OR {NO_SECTIONS} OR (parsing_status IS NOT NULL AND parsing_status <> '' AND NOT contains(lower(parsing_status), 'grobid')))),
k AS (SELECT *, CASE WHEN ov THEN 'grobid' ELSE chosen END AS pu, ha AND (ht OR hx) AND NOT ov AS skip FROM d),
changes AS (SELECT k.doi, k.pu AS parser_used, k.ov AS override, k.skip AS skipped, CASE WHEN NOT skip AND NOT ha AND c.na <> '' THEN c.na END AS abstract,
 CASE WHEN NOT skip AND (NOT ht OR ov) THEN c.nt END AS full_text, CASE WHEN NOT skip AND (NOT hx OR ov) THEN c.js END AS full_text_sections,
 CASE WHEN skip THEN NULL WHEN ov THEN old || ' | grobid: success'
  WHEN t.pymupdf_status = 'success' AND t.grobid_status = 'success' THEN 'success (parser: PyMuPDF) | grobid: success' WHEN t.pymupdf_status = 'success' THEN 'success (parser: PyMuPDF)'
  WHEN t.grobid_status = 'success' THEN 'success (parser: grobid)' ELSE 'parser: ' || CASE WHEN pu = 'pymupdf' THEN 'PyMuPDF' ELSE pu END END AS parsing_status
 FROM k LEFT JOIN c ON k.stem = c.stem AND k.pu = c.parser LEFT JOIN tracker t ON k.doi = t.doi)
"""
IMPORT_VIEWS = ("papers", "extractions", "tracker")


def _changes(s: Source):
    return merge.import_changes(s.papers, s.bodies, s.tracker)


@query(
    "import_changes", *IMPORT_VIEWS,
    sql=IMPORT + "SELECT doi, parser_used, override, skipped, abstract, md5(full_text) AS text_md5, md5(full_text_sections) AS sections_md5, parsing_status FROM changes",
)
def import_changes(spark, sf_dir):
    return _changes(Source(spark, sf_dir)).select(
        "doi", "parser_used", "override", "skipped", "abstract", F.md5("full_text").alias("text_md5"), F.md5("full_text_sections").alias("sections_md5"), "parsing_status"
    )


@query(
    "import_counters", *IMPORT_VIEWS,
    sql=IMPORT + """SELECT count(*) AS json_updates, count(*) FILTER (WHERE skipped) AS skipped_already_complete, count(abstract) AS abstract_updated, count(full_text) AS sections_updated,
 count(parsing_status) AS status_from_jsons, count(*) FILTER (WHERE NOT skipped AND broken) AS errors FROM (SELECT changes.*, e.state = 'broken' AS broken FROM changes
 JOIN extractions e ON e.stem = replace(changes.doi, '/', '_') AND e.parser = changes.parser_used) x""",
)
def import_counters(spark, sf_dir):
    """Counters observed while the changes are written, not counted by a scan of their own."""
    counters = merge.write_import(_changes(Source(spark, sf_dir)), f"{scratch_folder(spark)}/changes")
    return spark.createDataFrame([counters])


MERGED = """, m AS (SELECT p.pmid, p.doi, coalesce(c.abstract, p.abstract) AS abstract, coalesce(c.full_text, p.full_text) AS full_text, coalesce(c.full_text_sections, p.full_text_sections) AS full_text_sections,
 coalesce(c.parsing_status, p.parsing_status) AS parsing_status FROM papers p LEFT JOIN changes c ON p.doi = c.doi)"""
OUT = "SELECT pmid, doi, md5(abstract) AS abstract_md5, md5(full_text) AS text_md5, md5(full_text_sections) AS sections_md5, parsing_status FROM "


def _out(df):
    return df.select(
        "pmid", "doi", F.md5("abstract").alias("abstract_md5"), F.md5("full_text").alias("text_md5"), F.md5("full_text_sections").alias("sections_md5"), "parsing_status"
    )


@query("import_merge", *IMPORT_VIEWS, sql=IMPORT + MERGED + OUT + "m")
def import_merge(spark, sf_dir):
    s = Source(spark, sf_dir)
    return _out(merge.apply_changes(s.papers, _changes(s)))


LATEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY ts DESC, file_ord, pos) AS rn FROM run_log) x WHERE rn = 1"


def _log(spark, sf_dir):
    return merge.latest_log_entry(logs.parse_blocks(fixtures.run_log_blocks(spark, sf_dir)))


@query(
    "update_all", *IMPORT_VIEWS, "run_log",
    sql=IMPORT + MERGED + f""", lg AS ({LATEST}),
u AS (SELECT m.* REPLACE (CASE WHEN coalesce(m.parsing_status, '') <> '' THEN m.parsing_status WHEN m.doi IS NULL OR m.doi = '' THEN 'no DOI available'
 WHEN m.doi NOT IN (SELECT doi FROM tracker) THEN 'not required - already populated' WHEN lg.doi IS NULL THEN 'not processed - not found in logs'
 WHEN lg.parser IS NOT NULL THEN lg.result || ' (parser: ' || lg.parser || ')' ELSE lg.result END AS parsing_status) FROM m LEFT JOIN lg ON m.doi = lg.doi)
""" + OUT + "u",
)
def update_all(spark, sf_dir):
    s = Source(spark, sf_dir)
    tracker = s.tracker
    return _out(merge.update_all(s.papers, s.bodies, tracker, tracker.select("doi"), _log(spark, sf_dir)))


@query(
    "legacy_import", *IMPORT_VIEWS, "run_log",
    sql=IMPORT + f""", lg AS ({LATEST})
SELECT p.doi, CASE WHEN NOT {filled('p.abstract')} AND c.na <> '' THEN c.na END AS abstract, md5(CASE WHEN NOT {filled('p.full_text_sections')} THEN c.js END) AS sections_md5,
 CASE WHEN lg.doi IS NOT NULL THEN lg.result || ' (parser: ' || q.label || ')' ELSE 'parser: ' || q.label END AS parsing_status
FROM papers p JOIN (SELECT stem, CASE WHEN hs THEN 'grobid' ELSE 'pymupdf' END AS parser, CASE WHEN hs THEN 'grobid' ELSE 'PyMuPDF' END AS label FROM ch) q ON replace(p.doi, '/', '_') = q.stem
LEFT JOIN c ON q.stem = c.stem AND q.parser = c.parser LEFT JOIN lg ON p.doi = lg.doi WHERE p.doi IN (SELECT doi FROM tracker)""",
)
def legacy_import(spark, sf_dir):
    s = Source(spark, sf_dir)
    changes = merge.legacy_import_changes(s.papers, s.bodies, _log(spark, sf_dir), s.tracker)
    return changes.select("doi", "abstract", F.md5("full_text_sections").alias("sections_md5"), "parsing_status")


LOADER = PARSED.replace("GROUP BY stem, parser, title)", f"AND trim(row, {WS}) <> '' GROUP BY stem, parser, title)") + f"""
, c AS (SELECT e.stem, bool_or(e.parser = 'grobid' AND x.js IS NOT NULL) AS g, max(CASE WHEN e.parser = 'grobid' AND e.state <> 'broken' AND e.n_chars % 3 <> 0 AND trim(e.text, {WS}) <> '' THEN e.text END) AS a,
 max(CASE WHEN e.parser = 'grobid' THEN x.js END) AS gj, max(CASE WHEN e.parser = 'pymupdf' THEN x.js END) AS pj FROM extractions e LEFT JOIN x ON e.stem = x.stem AND e.parser = x.parser GROUP BY e.stem)
"""


@query(
    "loader_changes", "extractions", "papers",
    sql=LOADER + f"""SELECT DISTINCT p.doi, c.a AS abstract, md5(coalesce(gj, pj)) AS sections_md5, CASE WHEN g THEN 'success (parser: grobid)' ELSE 'success (parser: pymupdf)' END AS parsing_status
FROM papers p JOIN c ON replace(p.doi, '/', '_') = c.stem WHERE {HAS_DOI.replace('doi', 'p.doi')} AND {NO_TEXT} AND {NO_SECTIONS} AND coalesce(gj, pj) IS NOT NULL""",
)
def loader_changes(spark, sf_dir):
    from ..operators import gaps

    s = Source(spark, sf_dir)
    keys = gaps.keyed(s.papers).filter(gaps.missing_all_text())
    return merge.loader_changes(keys, s.bodies).select("doi", "abstract", F.md5("full_text_sections").alias("sections_md5"), "parsing_status")


FETCHED = f"""
WITH n AS (SELECT CAST(doc_id AS VARCHAR) AS pmid, CASE WHEN n_chars % 4 <> 0 THEN text ELSE '' END AS a, CASE WHEN n_chars % 5 <> 0 THEN text END AS t, '[]' AS s FROM documents),
g AS (SELECT pmid, bool_or({NO_ABSTRACT}) AS na, bool_or({NO_TEXT}) AS nt FROM papers WHERE pmid <> '' AND ({NO_TEXT} OR {NO_ABSTRACT}) GROUP BY pmid),
c AS (SELECT * FROM (SELECT g.pmid, CASE WHEN na THEN nullif(n.a, '') END AS abstract, CASE WHEN nt THEN nullif(n.t, '') END AS full_text, CASE WHEN nt AND nullif(n.t, '') IS NOT NULL THEN n.s END AS full_text_sections
 FROM g JOIN n ON g.pmid = n.pmid) x WHERE abstract IS NOT NULL OR full_text IS NOT NULL)
"""


def _fetched(s: Source):
    fetched = s.documents.select(
        F.col("doc_id").cast("string").alias("pmid"), F.when(F.col("n_chars") % 4 != 0, F.col("text")).otherwise("").alias("abstract"),
        F.when(F.col("n_chars") % 5 != 0, F.col("text")).alias("full_text"), F.lit("[]").alias("full_text_sections"),
    )
    return merge.fetched_changes(s.papers, fetched)


@query("fetched_changes", "papers", sql=FETCHED + "SELECT * FROM c")
def fetched_changes(spark, sf_dir):
    return _fetched(Source(spark, sf_dir))


@query(
    "fetched_merge", "papers",
    sql=FETCHED + """SELECT p.pmid, p.doi, coalesce(c.abstract, p.abstract) AS abstract, md5(coalesce(c.full_text, p.full_text)) AS text_md5,
 md5(coalesce(c.full_text_sections, p.full_text_sections)) AS sections_md5 FROM papers p LEFT JOIN c ON p.pmid = c.pmid""",
)
def fetched_merge(spark, sf_dir):
    s = Source(spark, sf_dir)
    merged = merge.apply_changes(s.papers, _fetched(s), "pmid")
    return merged.select("pmid", "doi", "abstract", F.md5("full_text").alias("text_md5"), F.md5("full_text_sections").alias("sections_md5"))


@query(
    "oa_url_merge", "papers", "pdfs",
    sql=f"""SELECT p.pmid, coalesce(u.url, p.oa_url) AS oa_url FROM papers p LEFT JOIN (SELECT DISTINCT stem, 'https://files.example.org/' || stem AS url FROM pdfs WHERE dir = 'pdfs') u
ON replace(p.doi, '/', '_') = u.stem""",
)
def oa_url_merge(spark, sf_dir):
    from ..operators import inventory

    s = Source(spark, sf_dir)
    found = inventory.with_doi(s.pdfs.filter("dir = 'pdfs'").select("stem"), s.papers).select("doi", F.concat(F.lit("https://files.example.org/"), "stem").alias("oa_url"))
    return merge.apply_changes(s.papers, merge.oa_url_changes(s.papers, found)).select("pmid", "oa_url")


NO_STATUS = "(parsing_status IS NULL OR parsing_status = '')"


@query(
    "mark_complete", "papers", "run_log",
    sql=f"SELECT DISTINCT doi, 'not required - already populated' AS parsing_status FROM papers WHERE {HAS_DOI} AND {NO_STATUS} AND doi NOT IN (SELECT doi FROM run_log)",
)
def mark_complete(spark, sf_dir):
    s = Source(spark, sf_dir)
    return merge.complete_changes(s.papers, s.run_log)


@query(
    "status_from_logs", "papers", "run_log",
    sql=f"""SELECT p.doi, CASE WHEN l.doi IS NULL THEN 'not processed - not found in logs' WHEN l.parser IS NOT NULL THEN l.result || ' (parser: ' || l.parser || ')' ELSE l.result END AS parsing_status
FROM (SELECT DISTINCT doi FROM papers WHERE {HAS_DOI} AND {NO_STATUS}) p LEFT JOIN ({LATEST}) l ON p.doi = l.doi""",
)
def status_from_logs(spark, sf_dir):
    return merge.log_changes(Source(spark, sf_dir).papers, _log(spark, sf_dir))


@query(
    "mark_no_doi", "papers",
    sql=f"SELECT pmid, CASE WHEN (doi IS NULL OR doi = '') AND {NO_STATUS} THEN 'no DOI available' ELSE parsing_status END AS parsing_status FROM papers",
)
def mark_no_doi(spark, sf_dir):
    return merge.mark_without_doi(Source(spark, sf_dir).papers).select("pmid", "parsing_status")
