"""Files: validity, presence, directory reports; and their agreement with the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..functions import validity as VA
from ..operators import inventory, ledger, reconcile
from ..session import scratch_folder
from ..sources import sinks
from .gap_queries import HAS_DOI, NO_SECTIONS, NO_TEXT, WS
from .registry import Source, query

LINE_CHARS = f"coalesce(list_sum(list_transform(string_split(text, chr(10)), lambda x: length(trim(x, {WS})))), 0)"
VALID = f"""CASE WHEN state = 'broken' THEN false
 WHEN parser = 'grobid' THEN length(trim(CASE WHEN state = 'untitled' THEN 'none' ELSE split_part(text, chr(10), 1) END, {WS})) >= 5 OR (state <> 'empty' AND {LINE_CHARS} >= 50)
 ELSE state <> 'empty' AND (length(trim(text, {WS})) >= 50 OR {LINE_CHARS} >= 50) END"""
PDF_VALID = "(n_chars % 5 <> 0 AND n_chars % 7 <> 0 AND n_chars % 6000 + 5 <= 4096 AND 10 + strlen(text) + n_chars % 6000 >= 1024)"
HAS_CONTENT = "(state NOT IN ('broken', 'empty') AND (parser = 'pymupdf' OR text <> '' AND replace(text, chr(10), '') <> ''))"
CONTENT = f"""SELECT stem, parser, state <> 'broken' AS is_valid, {HAS_CONTENT} AS has_content,
 CASE WHEN state = 'broken' THEN 'Invalid JSON' WHEN NOT {HAS_CONTENT} THEN 'Empty content' END AS reason FROM extractions"""


@query("json_validity", "extractions", sql=f"SELECT stem, parser, {VALID} AS is_valid, state <> 'broken' AS is_plain FROM extractions")
def json_validity(spark, sf_dir):
    checked = VA.with_plain_check(VA.with_validity(VA.parse_bodies(Source(spark, sf_dir).bodies)))
    return checked.select("stem", "parser", "is_valid", "is_plain")


@query("json_content_check", "extractions", sql=CONTENT)
def json_content_check(spark, sf_dir):
    return VA.with_content_check(Source(spark, sf_dir).bodies).select("stem", "parser", "is_valid", "has_content", "reason")


@query(
    "json_section_list_check", "extractions",
    sql="SELECT stem, parser, state <> 'broken' AS is_valid, state NOT IN ('broken', 'empty') AS has_content FROM extractions",
)
def json_section_list_check(spark, sf_dir):
    return VA.with_section_list_check(Source(spark, sf_dir).bodies).select("stem", "parser", "is_valid", "has_content")


TYPES = f"SELECT *, CASE WHEN NOT is_valid THEN 'invalid' WHEN NOT has_content THEN 'empty' ELSE 'valid' END AS type FROM ({CONTENT}) c"


@query("validity_stats", "extractions", sql=f"SELECT type, parser, count(*) AS files FROM ({TYPES}) t GROUP BY type, parser")
def validity_stats(spark, sf_dir):
    return inventory.validity_statistics(Source(spark, sf_dir).bodies)


@query(
    "validity_examples", "extractions",
    sql=f"""SELECT kind, CAST(rank AS INT) AS rank, stem FROM (SELECT type || '_' || parser AS kind, stem,
 row_number() OVER (PARTITION BY type, parser ORDER BY stem) AS rank FROM ({TYPES}) t WHERE type <> 'valid') r WHERE rank <= 5""",
)
def validity_examples(spark, sf_dir):
    return inventory.validity_examples(Source(spark, sf_dir).bodies)


@query(
    "quarantine", "extractions",
    sql=f"""SELECT e.stem, e.parser, coalesce(c.reason, 'Too little content') AS reason FROM (SELECT *, {VALID} AS ok FROM extractions) e
JOIN ({CONTENT}) c ON e.stem = c.stem AND e.parser = c.parser WHERE NOT e.ok""",
)
def quarantine(spark, sf_dir):
    return inventory.quarantine(Source(spark, sf_dir).bodies).select("stem", "parser", "reason")


@query(
    "routed_write", "extractions",
    sql=f"""SELECT e.stem, e.parser, CASE WHEN e.ok THEN 'usable' ELSE 'quarantine' END AS route, CASE WHEN NOT e.ok THEN coalesce(c.reason, 'Too little content') END AS reason
FROM (SELECT *, {VALID} AS ok FROM extractions) e JOIN ({CONTENT}) c ON e.stem = c.stem AND e.parser = c.parser""",
)
def routed_write(spark, sf_dir):
    """Good and bad extractions leave one parse in one write; both sides are read back from their folders."""
    path = f"{scratch_folder(spark)}/routed"
    sinks.write_routed(inventory.routed(Source(spark, sf_dir).bodies), path)
    sides = [spark.read.parquet(path).filter(F.col("route") == side) for side in ("usable", "quarantine")]
    return sides[0].unionAll(sides[1]).select("stem", "parser", "route", "reason")


@query(
    "valid_parser_sets", "extractions", "papers", "tracker",
    sql=f"SELECT doi, string_agg(parser, ',' ORDER BY parser) AS parsers FROM {fixtures.with_doi('extractions', 'papers', 'tracker')} e WHERE {VALID} GROUP BY doi",
)
def valid_parser_sets(spark, sf_dir):
    s = Source(spark, sf_dir)
    keys = inventory.valid_parsers(s.bodies, s.papers, s.tracker)
    return inventory.parser_sets(keys).select("doi", F.array_join("parsers", ",").alias("parsers"))


@query(
    "present_parser_sets", "extractions", "papers", "tracker",
    sql=f"SELECT doi, string_agg(parser, ',' ORDER BY parser) AS parsers FROM {fixtures.with_doi('extractions', 'papers', 'tracker')} e GROUP BY doi",
)
def present_parser_sets(spark, sf_dir):
    s = Source(spark, sf_dir)
    keys = inventory.with_doi(s.presence, s.papers, s.tracker).select("doi", "parser")
    return inventory.parser_sets(keys).select("doi", F.array_join("parsers", ",").alias("parsers"))


@query(
    "pdf_validity",
    sql=f"""SELECT doc_id, CAST(5 + strlen(text) + CASE WHEN n_chars % 7 = 0 THEN 0 ELSE 5 END + n_chars % 6000 AS BIGINT) AS length,
 {PDF_VALID} AS is_valid FROM documents""",
)
def pdf_validity(spark, sf_dir):
    files = fixtures.pdf_files(spark, sf_dir)
    return files.select("doc_id", "length", VA.is_valid_pdf(F.col("length"), F.col("content")).alias("is_valid"))


@query(
    "lenient_pdf",
    sql=f"SELECT doc_id, length(trim(text, {WS})) >= 200 OR n_chars % 3 >= 1 AS accepted FROM documents",
)
def lenient_pdf(spark, sf_dir):
    docs = Source(spark, sf_dir).documents
    return docs.select("doc_id", VA.is_lenient_pdf(F.col("text"), (F.col("n_chars") % 3).cast("int")).alias("accepted"))


@query(
    "dir_totals", "pdfs",
    sql="SELECT dir, count(*) AS files, CAST(sum(length) AS BIGINT) AS bytes, max(mtime_s) AS latest_s FROM pdfs GROUP BY dir",
)
def dir_totals(spark, sf_dir):
    return inventory.directory_totals(Source(spark, sf_dir).pdfs)


DIFF = """SELECT coalesce(a.stem, b.stem) AS stem, CASE WHEN b.stem IS NULL THEN 'only_papers' WHEN a.stem IS NULL THEN 'only_pdfs'
 WHEN a.length = b.length THEN 'same_size' ELSE 'different_size' END AS state
FROM (SELECT * FROM pdfs WHERE dir = 'papers') a FULL JOIN (SELECT * FROM pdfs WHERE dir = 'pdfs') b ON a.stem = b.stem"""


@query("dir_diff", "pdfs", sql=DIFF)
def dir_diff(spark, sf_dir):
    return inventory.directory_diff(Source(spark, sf_dir).pdfs)


@query("dir_overlap", "pdfs", sql=f"SELECT state, count(*) AS files FROM ({DIFF}) d GROUP BY state")
def dir_overlap(spark, sf_dir):
    return inventory.directory_overlap(Source(spark, sf_dir).pdfs)


@query("dir_intersection", "pdfs", sql="SELECT stem FROM pdfs WHERE dir = 'papers' INTERSECT SELECT stem FROM pdfs WHERE dir = 'pdfs'")
def dir_intersection(spark, sf_dir):
    return inventory.in_both(Source(spark, sf_dir).pdfs)


@query(
    "dir_advice", "pdfs",
    sql="""SELECT papers_files, pdfs_files, CASE WHEN papers_files > pdfs_files * 10 THEN 'consolidate to papers' WHEN pdfs_files > papers_files * 2 THEN 'consolidate to pdfs'
 ELSE 'consolidate to papers (historical standard)' END AS advice, CASE WHEN pl > dl THEN 'papers' ELSE 'pdfs' END AS more_active
FROM (SELECT count(*) FILTER (WHERE dir = 'papers') AS papers_files, count(*) FILTER (WHERE dir = 'pdfs') AS pdfs_files,
 max(mtime_s) FILTER (WHERE dir = 'papers') AS pl, max(mtime_s) FILTER (WHERE dir = 'pdfs') AS dl FROM pdfs) x""",
)
def dir_advice(spark, sf_dir):
    return inventory.consolidation_advice(Source(spark, sf_dir).pdfs)


@query(
    "pdfs_without_json", "pdfs", "extractions",
    sql="SELECT DISTINCT stem FROM pdfs WHERE stem NOT IN (SELECT stem FROM extractions WHERE parser = 'grobid')",
)
def pdfs_without_json(spark, sf_dir):
    s = Source(spark, sf_dir)
    return inventory.files_without_extraction(s.pdfs, s.presence)


STATE = "CASE WHEN state = 'broken' THEN 'json_invalid' WHEN state = 'empty' THEN 'json_empty' ELSE 'ok' END"


@query(
    "content_with_artefact", "papers", "extractions",
    sql=f"""
WITH f AS (SELECT stem, max({STATE}) FILTER (WHERE parser = 'grobid') AS g, max({STATE}) FILTER (WHERE parser = 'pymupdf') AS p FROM extractions GROUP BY stem)
SELECT m.doi, CASE WHEN g <> 'ok' THEN g WHEN p <> 'ok' THEN p WHEN g IS NOT NULL AND p IS NOT NULL THEN 'has_both' WHEN g IS NOT NULL THEN 'has_grobid' ELSE 'has_pymupdf' END AS class,
 CASE WHEN g = 'ok' THEN 'grobid' WHEN p = 'ok' THEN 'pymupdf' END AS usable_parser
FROM f JOIN (SELECT DISTINCT doi FROM papers WHERE {HAS_DOI} AND {NO_TEXT} AND {NO_SECTIONS}) m ON replace(m.doi, '/', '_') = f.stem""",
)
def content_with_artefact(spark, sf_dir):
    s = Source(spark, sf_dir)
    return inventory.content_with_artefact(s.papers, s.bodies)


@query(
    "artefact_counts", "papers", "extractions",
    sql=f"""
WITH f AS (SELECT stem, bool_or(parser = 'grobid') AS g, bool_or(parser = 'pymupdf') AS p FROM extractions GROUP BY stem)
SELECT count(*) AS missing, count(*) FILTER (WHERE g) AS have_json, count(*) FILTER (WHERE p AND NOT g) AS have_fast, count(*) FILTER (WHERE g OR p) AS have_either
FROM (SELECT DISTINCT doi FROM papers WHERE {HAS_DOI} AND {NO_TEXT} AND {NO_SECTIONS}) m LEFT JOIN f ON replace(m.doi, '/', '_') = f.stem""",
)
def artefact_counts(spark, sf_dir):
    s = Source(spark, sf_dir)
    return inventory.artefact_counts(s.papers, s.presence)


@query(
    "artefact_coverage", "papers", "extractions",
    sql=f"""SELECT total AS total_dois, missing AS missing_both, total - missing AS has_content, structured AS structured_files, fast AS fast_files,
 round(missing * 100.0 / total, 2) AS missing_pct, round(structured * 100.0 / total, 2) AS structured_pct, round(fast * 100.0 / total, 2) AS fast_pct
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE {NO_TEXT} AND {NO_SECTIONS}) AS missing FROM papers WHERE {HAS_DOI}) p,
 (SELECT count(*) FILTER (WHERE parser = 'grobid') AS structured, count(*) FILTER (WHERE parser = 'pymupdf') AS fast FROM extractions) e""",
)
def artefact_coverage(spark, sf_dir):
    s = Source(spark, sf_dir)
    return inventory.artefact_coverage(s.papers, s.presence)


ATTEMPTS = """SELECT doi, count(*) FILTER (WHERE event_type = 'download' AND status_to = 'scihub') AS scihub_attempts,
 count(*) FILTER (WHERE event_type = 'download' AND status_to = 'oa') AS oa_attempts, count(*) FILTER (WHERE event_type = 'pymupdf') AS pymupdf_attempts,
 count(*) FILTER (WHERE event_type = 'grobid') AS grobid_attempts FROM ledger_events GROUP BY doi"""


@query("attempt_counts", "ledger_events", sql=ATTEMPTS)
def attempt_counts(spark, sf_dir):
    return reconcile.attempt_counts(Source(spark, sf_dir).ledger_events)


FILES = "SELECT stem, max(CASE WHEN parser = 'pymupdf' THEN 1 ELSE 0 END) AS p, max(CASE WHEN parser = 'grobid' THEN 1 ELSE 0 END) AS g FROM extractions GROUP BY stem"


@query(
    "processing_state", "tracker", "ledger_events", "extractions",
    sql=f"""SELECT t.doi, scihub_available, scihub_downloaded, oa_available, oa_downloaded, downloaded, download_date, pymupdf_status, grobid_status,
 CAST(coalesce(pymupdf_attempts, 0) AS INT) AS pymupdf_attempts, CAST(coalesce(grobid_attempts, 0) AS INT) AS grobid_attempts,
 CAST(coalesce(scihub_attempts, 0) AS INT) AS scihub_attempts, CAST(coalesce(oa_attempts, 0) AS INT) AS oa_attempts,
 CAST(coalesce(p, 0) AS INT) AS files_pymupdf, CAST(coalesce(g, 0) AS INT) AS files_grobid,
 CAST(CASE WHEN (coalesce(p, 0) = 1) <> (coalesce(pymupdf_status, '') = 'success') OR (coalesce(g, 0) = 1) <> (coalesce(grobid_status, '') = 'success') THEN 1 ELSE 0 END AS INT) AS mismatch_files_tracker,
 last_updated FROM tracker t LEFT JOIN ({ATTEMPTS}) a ON t.doi = a.doi LEFT JOIN ({FILES}) f ON replace(t.doi, '/', '_') = f.stem""",
)
def processing_state(spark, sf_dir):
    s = Source(spark, sf_dir)
    return reconcile.processing_state(s.tracker, s.ledger_events, s.presence)


LOST = f"""SELECT t.doi, 'pymupdf' AS parser FROM tracker t LEFT JOIN ({FILES}) f ON replace(t.doi, '/', '_') = f.stem WHERE pymupdf_status = 'success' AND coalesce(p, 0) = 0
UNION ALL SELECT t.doi, 'grobid' FROM tracker t LEFT JOIN ({FILES}) f ON replace(t.doi, '/', '_') = f.stem WHERE grobid_status = 'success' AND coalesce(g, 0) = 0"""


@query("status_without_artefact", "tracker", "extractions", sql=LOST)
def status_without_artefact(spark, sf_dir):
    s = Source(spark, sf_dir)
    return reconcile.success_without_file(s.tracker, s.presence)


@query(
    "reset_missing", "tracker", "extractions",
    sql=f"""SELECT doi, max(CASE WHEN parser = 'pymupdf' THEN 'not_attempted' END) AS pymupdf_status, max(CASE WHEN parser = 'grobid' THEN 'not_attempted' END) AS grobid_status
FROM ({LOST}) l GROUP BY doi""",
)
def reset_missing(spark, sf_dir):
    s = Source(spark, sf_dir)
    return reconcile.reset_missing(s.tracker, s.presence)


@query("reset_missing_counts", "tracker", "extractions", sql=f"SELECT parser, count(*) AS resets FROM ({LOST}) l GROUP BY parser")
def reset_missing_counts(spark, sf_dir):
    s = Source(spark, sf_dir)
    return reconcile.reset_missing_counts(s.tracker, s.presence)


@query(
    "invalid_updates", "extractions", "tracker",
    sql=f"""
WITH b AS (SELECT doi, parser, parser || ': ' || reason AS message FROM {fixtures.with_doi(f'({CONTENT})', 'tracker')} c WHERE NOT is_valid OR NOT has_content),
g AS (SELECT doi, CAST(count(*) AS INT) AS steps, max(CASE WHEN parser = 'pymupdf' THEN 'failed' END) AS pymupdf_status, max(CASE WHEN parser = 'grobid' THEN 'failed' END) AS grobid_status,
 max(CASE WHEN parser = 'pymupdf' THEN CAST('2024-06-01 00:00:00' AS TIMESTAMP) END) AS pymupdf_date, max(CASE WHEN parser = 'grobid' THEN CAST('2024-06-01 00:00:00' AS TIMESTAMP) END) AS grobid_date,
 arg_min(message, parser) AS error_msg FROM b GROUP BY doi)
SELECT g.doi, g.pymupdf_status, g.grobid_status, g.pymupdf_date, g.grobid_date, g.error_msg, CASE WHEN t.doi IS NULL THEN steps - 1 ELSE t.retry_count + steps END AS retry_count FROM g LEFT JOIN tracker t ON g.doi = t.doi""",
)
def invalid_updates(spark, sf_dir):
    s = Source(spark, sf_dir)
    return reconcile.invalid_updates(s.bodies, s.tracker, F.lit("2024-06-01 00:00:00"))


@query(
    "structured_scan", "extractions", "tracker",
    sql=f"""SELECT doi, 'yes' AS downloaded, 'yes' AS scihub_available, 'success' AS grobid_status FROM {fixtures.with_doi('extractions', 'tracker')} e
WHERE parser = 'grobid' AND doi NOT IN (SELECT doi FROM tracker WHERE grobid_status = 'success')""",
)
def structured_scan(spark, sf_dir):
    s = Source(spark, sf_dir)
    return reconcile.structured_scan(s.presence, s.tracker)


@query("seeds_from_papers", "papers", "tracker", sql=f"SELECT DISTINCT doi FROM papers WHERE {HAS_DOI} AND doi NOT IN (SELECT doi FROM tracker)")
def seeds_from_papers(spark, sf_dir):
    s = Source(spark, sf_dir)
    return reconcile.seeds_from_papers(s.papers, s.tracker)


@query(
    "seeds_from_files", "extractions", "pdfs", "tracker",
    sql=f"""SELECT doi, max(d) AS downloaded FROM {fixtures.with_doi("(SELECT stem, NULL AS d FROM extractions UNION ALL SELECT stem, 'yes' FROM pdfs)", 'tracker')} f
WHERE doi NOT IN (SELECT doi FROM tracker) GROUP BY doi""",
)
def seeds_from_files(spark, sf_dir):
    s = Source(spark, sf_dir)
    return reconcile.seeds_from_files(s.presence, s.pdfs, s.tracker)


@query(
    "rebuild_tracker", "papers", "extractions", "pdfs",
    sql=f"""
WITH k AS (SELECT doi FROM papers WHERE {HAS_DOI} UNION SELECT doi FROM {fixtures.with_doi('extractions', 'papers')} e UNION SELECT doi FROM {fixtures.with_doi('pdfs', 'papers')} p),
c AS (SELECT doi, bool_or(coalesce(trim(abstract, {WS}) <> '', false) OR coalesce(trim(full_text, {WS}) <> '', false) OR coalesce(trim(full_text_sections, {WS}) <> '', false)) AS c FROM papers WHERE {HAS_DOI} GROUP BY doi),
s AS (SELECT DISTINCT doi FROM {fixtures.with_doi('pdfs', 'papers')} p WHERE dir = 'papers'), o AS (SELECT DISTINCT doi FROM {fixtures.with_doi('pdfs', 'papers')} p WHERE dir = 'pdfs'),
f AS (SELECT * FROM {fixtures.with_doi(f'({FILES})', 'papers')} q)
SELECT k.doi, CASE WHEN s.doi IS NOT NULL THEN 'yes' END AS scihub_available, CASE WHEN s.doi IS NOT NULL THEN 'yes' END AS scihub_downloaded,
 CASE WHEN o.doi IS NOT NULL THEN 'yes' END AS oa_available, CASE WHEN o.doi IS NOT NULL THEN 'yes' END AS oa_downloaded,
 CASE WHEN s.doi IS NOT NULL OR o.doi IS NOT NULL THEN 'yes' END AS downloaded, CASE WHEN s.doi IS NOT NULL OR o.doi IS NOT NULL THEN CAST('2024-06-01 00:00:00' AS TIMESTAMP) END AS download_date,
 CASE WHEN c.c THEN 'yes' ELSE 'no' END AS has_content_in_db, CASE WHEN p = 1 THEN 'success' END AS pymupdf_status, CASE WHEN p = 1 THEN CAST('2024-06-01 00:00:00' AS TIMESTAMP) END AS pymupdf_date,
 CASE WHEN g = 1 THEN 'success' END AS grobid_status, CASE WHEN g = 1 THEN CAST('2024-06-01 00:00:00' AS TIMESTAMP) END AS grobid_date,
 CAST(coalesce(p, 0) AS INT) AS pymupdf_attempts, CAST(coalesce(g, 0) AS INT) AS grobid_attempts, CASE WHEN s.doi IS NULL THEN 0 ELSE 1 END AS scihub_attempts, CASE WHEN o.doi IS NULL THEN 0 ELSE 1 END AS oa_attempts,
 CAST(coalesce(p, 0) AS INT) AS files_pymupdf, CAST(coalesce(g, 0) AS INT) AS files_grobid, 0 AS mismatch_files_tracker, 0 AS retry_count, CAST('2024-06-01 00:00:00' AS TIMESTAMP) AS last_updated
FROM k LEFT JOIN c ON k.doi = c.doi LEFT JOIN s ON k.doi = s.doi LEFT JOIN o ON k.doi = o.doi LEFT JOIN f ON k.doi = f.doi""",
)
def rebuild_tracker(spark, sf_dir):
    s = Source(spark, sf_dir)
    return reconcile.rebuild(s.papers, s.presence, s.pdfs, F.lit("2024-06-01 00:00:00"))


@query(
    "enrich_papers", "papers", "tracker", "extractions",
    sql=f"""SELECT x.doi, coalesce(scihub_available, 'unknown') AS scihub_available, coalesce(downloaded, 'unknown') AS downloaded,
 CASE WHEN u THEN 'yes' ELSE 'no' END AS oa_available, CASE WHEN c THEN 'yes' ELSE 'no' END AS has_content_in_db,
 CASE WHEN p = 1 THEN 'success' ELSE coalesce(pymupdf_status, 'not_attempted') END AS pymupdf_status, CASE WHEN g = 1 THEN 'success' ELSE coalesce(grobid_status, 'not_attempted') END AS grobid_status,
 coalesce(CAST(retry_count AS VARCHAR), '0') AS retry_count
FROM (SELECT doi, bool_or(coalesce(trim(full_text, {WS}) <> '', false) OR coalesce(trim(full_text_sections, {WS}) <> '', false)) AS c, bool_or(coalesce(trim(oa_url, {WS}) <> '', false)) AS u
 FROM papers WHERE {HAS_DOI} GROUP BY doi) x LEFT JOIN tracker t ON x.doi = t.doi LEFT JOIN ({FILES}) f ON replace(x.doi, '/', '_') = f.stem""",
)
def enrich_papers(spark, sf_dir):
    s = Source(spark, sf_dir)
    return reconcile.enrich(s.papers, s.tracker, s.presence)


def normalized(table: str) -> str:
    """SQL: ``identifier, doi`` of a table's identifiers, by the pipeline rule."""
    return f"""SELECT identifier, CASE WHEN n LIKE '10.%' AND contains(n, '/') THEN n END AS doi FROM (
 SELECT identifier, CASE WHEN v LIKE '/j/%.xml' AND split_part(v, '/', -2) || '.xml' = split_part(v, '/', -1) AND regexp_full_match(split_part(v, '/', -2), '[a-z0-9-]+')
  THEN '10.1515/' || split_part(v, '/', -2)
  ELSE trim(regexp_replace(v, '^(doi:|doi\\.org/|dx\\.doi\\.org/|http://dx\\.doi\\.org/|https://dx\\.doi\\.org/|http://doi\\.org/|https://doi\\.org/|https://www\\.doi\\.org/|http://www\\.doi\\.org/)', '', 'i'), {WS}) END AS n
 FROM (SELECT identifier, trim(identifier, {WS}) AS v FROM {table}) t0) t1"""


RESET = f"""
WITH l AS (SELECT identifier, count(*) AS n_listed FROM (SELECT identifier FROM id_list UNION ALL SELECT doi FROM tracker) x GROUP BY 1),
d AS ({normalized('l')}),
f AS (SELECT stem, bool_and({VALID}) FILTER (WHERE parser = 'grobid') AS g, bool_and({VALID}) FILTER (WHERE parser = 'pymupdf') AS p FROM extractions GROUP BY stem),
q AS (SELECT {fixtures.STEM} AS stem, {PDF_VALID} AS ok FROM documents),
j AS (SELECT d.identifier, d.doi, l.n_listed, d.doi IN (SELECT doi FROM run_log) AS skipped, q.ok AS pdf_ok, f.g, f.p
 FROM d JOIN l ON d.identifier = l.identifier LEFT JOIN q ON replace(d.doi, '/', '_') = q.stem LEFT JOIN f ON replace(d.doi, '/', '_') = f.stem),
a AS (SELECT *, coalesce(skipped, false) AS was, doi IS NOT NULL AND NOT coalesce(skipped, false) AS act FROM j),
b AS (SELECT *, act AND coalesce(NOT pdf_ok, false) AS bad FROM a),
r AS (SELECT identifier, doi, n_listed, was AS skipped_previously_reset, act AS reset_tracker, bad AS invalid_pdf,
 act AND NOT bad AND coalesce(NOT g, false) AS invalid_grobid_json, act AND NOT bad AND coalesce(NOT p, false) AS invalid_pymupdf_json,
 (bad AND g IS NOT NULL) OR (act AND NOT bad AND coalesce(NOT g, false)) AS drop_grobid_json, (bad AND p IS NOT NULL) OR (act AND NOT bad AND coalesce(NOT p, false)) AS drop_pymupdf_json FROM b)
"""
RESET_VIEWS = ("id_list", "tracker", "extractions", "run_log")


def _reset(spark, sf_dir):
    s = Source(spark, sf_dir)
    listed = s.id_list.select("identifier").unionByName(s.tracker.select(F.col("doi").alias("identifier")))
    files = fixtures.pdf_files(spark, sf_dir)
    pdfs = files.select("stem", VA.is_valid_pdf(F.col("length"), F.col("content")).alias("is_valid"))
    return reconcile.reset_actions(listed, s.run_log, pdfs, s.bodies)


@query("reset_plan", *RESET_VIEWS, sql=RESET + "SELECT * FROM r")
def reset_plan(spark, sf_dir):
    return _reset(spark, sf_dir)


@query(
    "reset_statistics", *RESET_VIEWS,
    sql=RESET + """, u AS (SELECT doi, bool_or(invalid_pdf) AS ip, bool_or(invalid_grobid_json) AS ig, bool_or(invalid_pymupdf_json) AS im, bool_or(drop_grobid_json) AS dg, bool_or(drop_pymupdf_json) AS dm FROM r WHERE reset_tracker GROUP BY doi)
SELECT CAST(x.total AS BIGINT) AS total_dois, CAST(x.skipped AS BIGINT) AS skipped_previously_reset, CAST(x.resets AS BIGINT) AS tracker_reset, y.ip AS invalid_pdfs, y.ig AS invalid_grobid_jsons, y.im AS invalid_pymupdf_jsons,
 y.ip AS pdfs_deleted, y.d AS jsons_deleted FROM
 (SELECT sum(n_listed) FILTER (WHERE NOT skipped_previously_reset) AS total, coalesce(sum(n_listed) FILTER (WHERE skipped_previously_reset), 0) AS skipped, coalesce(sum(n_listed) FILTER (WHERE reset_tracker), 0) AS resets FROM r) x,
 (SELECT count(*) FILTER (WHERE ip) AS ip, count(*) FILTER (WHERE ig) AS ig, count(*) FILTER (WHERE im) AS im, count(*) FILTER (WHERE dg) + count(*) FILTER (WHERE dm) AS d FROM u) y""",
)
def reset_statistics(spark, sf_dir):
    return reconcile.reset_statistics(_reset(spark, sf_dir))


@query("reset_history", *RESET_VIEWS, sql=RESET + "SELECT doi FROM run_log UNION SELECT doi FROM r WHERE reset_tracker")
def reset_history(spark, sf_dir):
    s = Source(spark, sf_dir)
    return reconcile.reset_history(s.run_log, _reset(spark, sf_dir))


@query(
    "reset_events", *RESET_VIEWS,
    sql=RESET + """SELECT DISTINCT doi, parser, 'failed' AS status FROM (SELECT doi, 'grobid' AS parser FROM r WHERE invalid_grobid_json
 UNION ALL SELECT doi, 'pymupdf' FROM r WHERE invalid_pymupdf_json) x""",
)
def reset_events(spark, sf_dir):
    return reconcile.reset_events(_reset(spark, sf_dir))


@query(
    "ledger_after_cleanup", "extractions", "tracker",
    sql=f"""
WITH b AS (SELECT doi, parser FROM {fixtures.with_doi(f'({CONTENT})', 'tracker')} c WHERE NOT is_valid OR NOT has_content),
g AS (SELECT doi, bool_or(parser = 'grobid') AS g, bool_or(parser = 'pymupdf') AS p FROM b GROUP BY doi)
SELECT coalesce(t.doi, g.doi) AS doi, CASE WHEN g.doi IS NULL THEN t.pymupdf_status WHEN g.p THEN 'failed' ELSE t.pymupdf_status END AS pymupdf_status,
 CASE WHEN g.doi IS NULL THEN t.grobid_status WHEN g.g THEN 'failed' ELSE t.grobid_status END AS grobid_status,
 CASE WHEN g.p THEN CAST('2024-06-01 00:00:00' AS TIMESTAMP) ELSE t.pymupdf_date END AS pymupdf_date, CASE WHEN g.g THEN CAST('2024-06-01 00:00:00' AS TIMESTAMP) ELSE t.grobid_date END AS grobid_date FROM tracker t FULL JOIN g ON t.doi = g.doi""",
)
def ledger_after_cleanup(spark, sf_dir):
    s = Source(spark, sf_dir)
    at = F.lit("2024-06-01 00:00:00").cast("timestamp")
    updates = reconcile.invalid_updates(s.bodies, s.tracker, at)
    after = ledger.patch(s.tracker, updates, at)
    return after.select("doi", "pymupdf_status", "pymupdf_date", "grobid_status", "grobid_date")
