"""Ledger fold, views of the ledger, status codes and tracker files."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..operators import inventory, ledger
from ..operators.gaps import select_keys
from .gap_queries import HAS_DOI, WS
from .registry import Source, query

PARSERS_SQL = ", ".join(
    f"arg_max(status_to, id) FILTER (WHERE event_type = '{p}') AS {p}_status, max(created_at) FILTER (WHERE event_type = '{p}') AS {p}_date"
    for p in ("pymupdf", "grobid")
)
# Event ids grow with time in the driver table, so the id alone orders events.
FOLD_SQL = f"""
WITH r AS (SELECT doi, max(id) AS rid FROM ledger_events WHERE event_type = 'reset' GROUP BY doi),
live AS (SELECT e.* FROM ledger_events e LEFT JOIN r ON e.doi = r.doi WHERE r.rid IS NULL OR e.id > r.rid),
f AS (SELECT doi,
 max('yes') FILTER (WHERE event_type = 'download' AND status_to = 'scihub') AS scihub_downloaded,
 max('yes') FILTER (WHERE event_type = 'download' AND status_to = 'oa') AS oa_downloaded,
 max('yes') FILTER (WHERE event_type = 'download') AS downloaded,
 max(created_at) FILTER (WHERE event_type = 'download') AS download_date,
 arg_max(status_to, id) FILTER (WHERE event_type = 'download' AND status_to IN ('scihub', 'oa')) AS download_source,
 {PARSERS_SQL}, arg_max(message, id) FILTER (WHERE event_type = 'error') AS error_msg,
 CAST(count(*) FILTER (WHERE event_type = 'retry_increment') AS INT) AS retry_count FROM live GROUP BY doi),
k AS (SELECT doi, max(created_at) AS last_updated FROM ledger_events GROUP BY doi)
SELECT k.doi, f.scihub_downloaded, f.oa_downloaded, f.downloaded, f.download_date, f.download_source, f.pymupdf_status, f.pymupdf_date,
 f.grobid_status, f.grobid_date, f.error_msg, k.last_updated, CAST(coalesce(f.retry_count, 0) AS INT) AS retry_count
FROM k LEFT JOIN f ON k.doi = f.doi"""
FOLD_COLUMNS = [
    "doi", "scihub_downloaded", "oa_downloaded", "downloaded", "download_date", "download_source", "pymupdf_status", "pymupdf_date",
    "grobid_status", "grobid_date", "error_msg", "last_updated", "retry_count",
]


@query("ledger_fold", "ledger_events", sql=FOLD_SQL)
def ledger_fold(spark, sf_dir):
    return ledger.fold(Source(spark, sf_dir).ledger_events).select(FOLD_COLUMNS)


SOURCES = ("arxiv", "biorxiv", "europepmc", "unpaywall")
SOURCE_COLUMNS = [
    "scihub_available", "oa_available", "scihub_downloaded", "oa_downloaded",
    *[f"{s}_{x}" for s in SOURCES for x in ("attempted", "downloaded")], "downloaded", "download_source", "grobid_status", "has_content_in_db",
]
CELLS = """SELECT doi, id, event_type AS c, status_to AS v FROM source_events WHERE event_type IN ('scihub_available', 'oa_available')
UNION ALL SELECT doi, id, status_to || '_downloaded', 'yes' FROM source_events WHERE event_type = 'download' AND status_to IN ('scihub', 'oa')
UNION ALL SELECT doi, id, 'downloaded', CASE WHEN status_to = 'failed' THEN 'no' ELSE 'yes' END FROM source_events WHERE event_type = 'download'
UNION ALL SELECT doi, id, 'download_source', status_to FROM source_events WHERE event_type = 'download' AND status_to NOT IN ('success', 'failed')
UNION ALL SELECT doi, id, upd_column, upd_value FROM source_events WHERE event_type = 'update'""" + "".join(
    f"""
UNION ALL SELECT doi, id, '{s}_attempted', 'yes' FROM source_events WHERE event_type = '{s}_attempted'
UNION ALL SELECT doi, id, '{s}_downloaded', CASE WHEN status_to = 'success' THEN 'yes' ELSE 'no' END FROM source_events WHERE event_type = '{s}_download'
UNION ALL SELECT doi, id, 'downloaded', 'yes' FROM source_events WHERE event_type = '{s}_download' AND status_to = 'success'
UNION ALL SELECT doi, id, 'download_source', '{s}' FROM source_events WHERE event_type = '{s}_download' AND status_to = 'success'"""
    for s in SOURCES
)


@query(
    "ledger_fold_sources", "source_events",
    sql=f"""
WITH r AS (SELECT doi, max(id) AS rid FROM source_events WHERE event_type = 'reset' GROUP BY doi),
c AS ({CELLS}),
f AS (SELECT c.doi, {', '.join(f"arg_max(v, id) FILTER (WHERE c = '{x}') AS {x}" for x in SOURCE_COLUMNS)} FROM c LEFT JOIN r ON c.doi = r.doi WHERE rid IS NULL OR id > rid GROUP BY c.doi),
k AS (SELECT e.doi, max(created_at) AS last_updated, CAST(count(*) FILTER (WHERE event_type = 'retry_increment' AND (rid IS NULL OR id > rid)) AS INT) AS retry_count
 FROM source_events e LEFT JOIN r ON e.doi = r.doi GROUP BY e.doi)
SELECT k.doi, {', '.join(SOURCE_COLUMNS)}, last_updated, retry_count FROM k LEFT JOIN f ON k.doi = f.doi""",
)
def ledger_fold_sources(spark, sf_dir):
    """Every kind of event but parsing: availability, attempts, downloads by source and outcome, plain updates."""
    events = Source(spark, sf_dir).source_events
    changes = F.when(F.col("upd_column").isNotNull(), F.create_map("upd_column", "upd_value"))
    return ledger.fold(events.withColumn("changes", changes)).select("doi", *SOURCE_COLUMNS, "last_updated", "retry_count")


@query(
    "ledger_upsert_order", "tracker", "ledger_events",
    sql="""
WITH u AS (SELECT doi, arg_max(status_to, id) AS g FROM ledger_events WHERE event_type = 'grobid' GROUP BY doi)
SELECT coalesce(t.doi, u.doi) AS doi, t.pymupdf_status, coalesce(u.g, t.grobid_status) AS grobid_status, coalesce(t.retry_count, 0) AS retry_count FROM tracker t FULL JOIN u ON t.doi = u.doi""",
)
def ledger_upsert_order(spark, sf_dir):
    """Several updates of one DOI apply in the order of their number."""
    s = Source(spark, sf_dir)
    updates = s.ledger_events.filter("event_type = 'grobid'").select("doi", "id", F.col("status_to").alias("grobid_status"))
    after = ledger.upsert(s.tracker, updates, F.lit("2024-06-01 00:00:00").cast("timestamp"), seq="id")
    return after.select("doi", "pymupdf_status", "grobid_status", "retry_count")


@query(
    "ledger_upsert", "tracker", "papers",
    sql=f"""
WITH n AS (SELECT doi, CASE WHEN parsing_status LIKE '%grobid%' THEN 'success' END AS g FROM papers WHERE {HAS_DOI})
SELECT coalesce(t.doi, n.doi) AS doi, t.downloaded, t.pymupdf_status, CASE WHEN n.doi IS NULL THEN t.grobid_status ELSE n.g END AS grobid_status,
 CASE WHEN n.doi IS NULL THEN t.last_updated ELSE CAST('2024-06-01 00:00:00' AS TIMESTAMP) END AS last_updated, coalesce(t.retry_count, 0) AS retry_count
FROM tracker t FULL JOIN n ON t.doi = n.doi""",
)
def ledger_upsert(spark, sf_dir):
    s = Source(spark, sf_dir)
    updates = s.papers.select("doi", F.when(F.col("parsing_status").contains("grobid"), "success").alias("grobid_status"))
    at = F.lit("2024-06-01 00:00:00").cast("timestamp")
    return ledger.upsert(s.tracker, updates, at).select("doi", "downloaded", "pymupdf_status", "grobid_status", "last_updated", "retry_count")


@query(
    "ledger_reset", "tracker", "run_log",
    sql="""
WITH k AS (SELECT DISTINCT doi FROM run_log)
SELECT coalesce(t.doi, k.doi) AS doi, CASE WHEN k.doi IS NULL THEN t.downloaded END AS downloaded, CASE WHEN k.doi IS NULL THEN t.grobid_status END AS grobid_status,
 CASE WHEN k.doi IS NULL THEN t.retry_count ELSE 0 END AS retry_count FROM tracker t FULL JOIN k ON t.doi = k.doi""",
)
def ledger_reset(spark, sf_dir):
    s = Source(spark, sf_dir)
    at = F.lit("2024-06-01 00:00:00").cast("timestamp")
    return ledger.reset(s.tracker, s.run_log, at).select("doi", "downloaded", "grobid_status", "retry_count")


@query("ledger_remove", "tracker", "run_log", sql="SELECT doi, retry_count FROM tracker WHERE doi NOT IN (SELECT doi FROM run_log)")
def ledger_remove(spark, sf_dir):
    s = Source(spark, sf_dir)
    return ledger.remove(s.tracker, s.run_log).select("doi", "retry_count")


@query("removal_preview", "tracker", "run_log", sql="SELECT count(*) AS present FROM tracker WHERE doi IN (SELECT doi FROM run_log)")
def removal_preview(spark, sf_dir):
    s = Source(spark, sf_dir)
    return ledger.removal_preview(s.tracker, s.run_log).agg(F.count(F.lit(1)).alias("present"))


@query(
    "tracker_for_keys", "tracker", "run_log",
    sql="SELECT doi, downloaded, pymupdf_status, grobid_status, retry_count FROM tracker WHERE doi IN (SELECT doi FROM run_log)",
)
def tracker_for_keys(spark, sf_dir):
    s = Source(spark, sf_dir)
    return select_keys(s.tracker, s.run_log).select("doi", "downloaded", "pymupdf_status", "grobid_status", "retry_count")


@query(
    "pending_by_stage", "tracker",
    sql="""SELECT 'download' AS stage, doi FROM tracker WHERE scihub_available = 'yes' AND downloaded IS DISTINCT FROM 'yes'
UNION ALL SELECT 'pymupdf', doi FROM tracker WHERE downloaded = 'yes' AND pymupdf_status IN ('not_attempted', 'failed')
UNION ALL SELECT 'grobid', doi FROM tracker WHERE downloaded = 'yes' AND grobid_status IN ('not_attempted', 'failed')""",
)
def pending_by_stage(spark, sf_dir):
    return ledger.pending_by_stage(Source(spark, sf_dir).tracker)


@query(
    "retryable", "tracker",
    sql="""SELECT 'download' AS category, doi FROM tracker WHERE retry_count < 3 AND downloaded = 'no'
UNION ALL SELECT 'pymupdf', doi FROM tracker WHERE retry_count < 3 AND pymupdf_status = 'failed'
UNION ALL SELECT 'grobid', doi FROM tracker WHERE retry_count < 3 AND grobid_status = 'failed'""",
)
def retryable(spark, sf_dir):
    return ledger.retryable(Source(spark, sf_dir).tracker)


@query(
    "parsed_ok", "tracker",
    sql="SELECT doi, pymupdf_status, grobid_status FROM tracker WHERE pymupdf_status = 'success' OR grobid_status = 'success'",
)
def parsed_ok(spark, sf_dir):
    return ledger.parsed_ok(Source(spark, sf_dir).tracker)


def _n(column: str, value: str) -> str:
    return f"count(*) FILTER (WHERE {column} = '{value}')"


STATS = ", ".join(
    ["count(*) AS total_dois", f"{_n('scihub_available', 'yes')} AS scihub_available", f"{_n('scihub_available', 'no')} AS scihub_not_found",
     f"{_n('downloaded', 'yes')} AS downloaded", f"{_n('downloaded', 'no')} AS download_failed"]
    + [f"{_n(p + '_status', v)} AS {p}_{n}" for p in ("pymupdf", "grobid") for v, n in (("success", "success"), ("failed", "failed"), ("not_attempted", "pending"))]
    + ["count(*) FILTER (WHERE pymupdf_status = 'success' OR grobid_status = 'success') AS fully_processed"]
)


@query(
    "tracker_stats", "tracker",
    sql=f"""SELECT *, total_dois - scihub_available - scihub_not_found AS scihub_unknown, round(fully_processed * 100.0 / total_dois, 2) AS completion_pct
FROM (SELECT {STATS} FROM tracker) x""",
)
def tracker_stats(spark, sf_dir):
    return ledger.statistics(Source(spark, sf_dir).tracker)


@query(
    "pending_counts", "tracker",
    sql="""SELECT count(*) AS total, count(*) FILTER (WHERE downloaded IS DISTINCT FROM 'yes') AS needs_download,
 count(*) FILTER (WHERE pymupdf_status IS DISTINCT FROM 'success') AS needs_pymupdf, count(*) FILTER (WHERE grobid_status IS DISTINCT FROM 'success') AS needs_grobid,
 count(*) FILTER (WHERE pymupdf_status = 'success' AND grobid_status = 'success') AS complete FROM tracker""",
)
def pending_counts(spark, sf_dir):
    return ledger.pending_counts(Source(spark, sf_dir).tracker)


@query(
    "status_histogram", "tracker", "papers",
    sql=f"""
WITH b AS (SELECT * FROM tracker WHERE doi IN (SELECT doi FROM papers WHERE {HAS_DOI}))
SELECT dimension, value, count(*) AS dois FROM (""" + " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {d} AS value FROM b" for d in ("scihub_available", "downloaded", "pymupdf_status", "grobid_status")
    ) + ") x GROUP BY dimension, value",
)
def status_histogram(spark, sf_dir):
    s = Source(spark, sf_dir)
    return ledger.status_histogram(s.tracker, s.papers)


@query(
    "source_reliability", "tracker",
    sql="""SELECT source, a AS attempted, d AS downloaded, CASE WHEN a > 0 THEN round(CAST(d AS DOUBLE) / a, 4) END AS rate FROM ("""
    + " UNION ALL ".join(
        f"SELECT '{s}' AS source, count(*) FILTER (WHERE {s}_attempted = 'yes') AS a, count(*) FILTER (WHERE {s}_downloaded = 'yes') AS d FROM tracker"
        for s in ("arxiv", "biorxiv", "europepmc", "unpaywall")
    )
    + " UNION ALL "
    + " UNION ALL ".join(
        f"SELECT '{s}' AS source, count(*) FILTER (WHERE {s}_downloaded IN ('yes', 'no')) AS a, count(*) FILTER (WHERE {s}_downloaded = 'yes') AS d FROM tracker"
        for s in ("scihub", "oa")
    )
    + ") x",
)
def source_reliability(spark, sf_dir):
    return ledger.source_reliability(Source(spark, sf_dir).tracker)


@query(
    "next_step", "tracker",
    sql="""SELECT doi, CASE WHEN downloaded IS DISTINCT FROM 'yes' THEN 'Download PDF'
 WHEN pymupdf_status IS NULL OR pymupdf_status NOT IN ('success', 'failed') THEN 'Process with PyMuPDF'
 WHEN grobid_status IS NULL OR grobid_status NOT IN ('success', 'failed') THEN 'Process with Grobid' ELSE 'Fully processed' END AS next_step FROM tracker""",
)
def next_step(spark, sf_dir):
    return ledger.next_step(Source(spark, sf_dir).tracker)


ENCODE = """CASE WHEN grobid_status = 'success' THEN 'success (parser: grobid)' WHEN pymupdf_status = 'success' THEN 'success (parser: PyMuPDF)'
 WHEN grobid_status = 'failed' THEN 'processing_failed (parser: grobid)' WHEN pymupdf_status = 'failed' THEN 'processing_failed (parser: PyMuPDF)'
 WHEN downloaded = 'no' THEN 'download_failed' WHEN scihub_available = 'no' THEN 'not_found' ELSE 'not_processed' END"""


@query("encode_status", "tracker", sql=f"SELECT doi, {ENCODE} AS parsing_status FROM tracker")
def encode_status(spark, sf_dir):
    return ledger.encoded(Source(spark, sf_dir).tracker)


@query(
    "export_statuses", "tracker", "papers",
    sql=f"SELECT doi, {ENCODE} AS parsing_status FROM tracker WHERE doi IN (SELECT doi FROM papers WHERE {HAS_DOI})",
)
def export_statuses(spark, sf_dir):
    s = Source(spark, sf_dir)
    return ledger.export_statuses(s.papers, s.tracker)


def _has(word: str) -> str:
    return f"contains(lower(coalesce(parsing_status, '')), '{word}')"


DECODE = f"""CASE WHEN {_has('not_found')} THEN 'no' END AS scihub_available,
 CASE WHEN {_has('success')} AND ({_has('grobid')} OR {_has('pymupdf')}) THEN 'yes' END AS downloaded,
 CASE WHEN {_has('pymupdf')} AND NOT {_has('grobid')} THEN CASE WHEN {_has('failed')} THEN 'failed' WHEN {_has('success')} THEN 'success' END END AS pymupdf_status,
 CASE WHEN {_has('grobid')} THEN CASE WHEN {_has('failed')} THEN 'failed' WHEN {_has('success')} THEN 'success' END END AS grobid_status"""
IMPLIED = "scihub_available IS NOT NULL OR downloaded IS NOT NULL OR pymupdf_status IS NOT NULL OR grobid_status IS NOT NULL"


@query("decode_status", "papers", sql=f"SELECT * FROM (SELECT doi, {DECODE} FROM papers WHERE {HAS_DOI}) x WHERE {IMPLIED}")
def decode_status(spark, sf_dir):
    return ledger.decoded(Source(spark, sf_dir).papers)


@query(
    "decode_initial", "papers",
    sql=f"""SELECT * FROM (SELECT doi,
 CASE WHEN {_has('success')} OR {_has('parser')} THEN 'yes' WHEN {_has('not_found')} THEN 'no' END AS scihub_available,
 CASE WHEN {_has('success')} OR {_has('parser')} THEN 'yes' WHEN {_has('not_found')} OR {_has('failed')} THEN 'no' END AS downloaded,
 CASE WHEN {_has('pymupdf')} THEN CASE WHEN {_has('success')} THEN 'success' WHEN {_has('failed')} THEN 'failed' ELSE 'not_attempted' END END AS pymupdf_status,
 CASE WHEN {_has('grobid')} THEN CASE WHEN {_has('success')} THEN 'success' WHEN {_has('failed')} THEN 'failed' ELSE 'not_attempted' END END AS grobid_status
 FROM papers WHERE {HAS_DOI}) x WHERE {IMPLIED}""",
)
def decode_initial(spark, sf_dir):
    return ledger.decoded_initial(Source(spark, sf_dir).papers)


@query(
    "add_new_rows", "papers", "tracker",
    sql=f"""SELECT doi, CASE WHEN {IMPLIED} THEN scihub_available ELSE 'unknown' END AS scihub_available, CASE WHEN {IMPLIED} THEN downloaded ELSE 'unknown' END AS downloaded,
 CASE WHEN {IMPLIED} THEN pymupdf_status ELSE 'not_attempted' END AS pymupdf_status, CASE WHEN {IMPLIED} THEN grobid_status ELSE 'not_attempted' END AS grobid_status
FROM (SELECT doi, {DECODE} FROM papers WHERE {HAS_DOI} AND doi NOT IN (SELECT doi FROM tracker)) x""",
)
def add_new_rows(spark, sf_dir):
    s = Source(spark, sf_dir)
    return ledger.new_rows(s.papers, s.tracker)


def _old_file(s: Source):
    t = s.tracker
    blank = F.lit("")
    return t.select(
        "doi", F.coalesce("scihub_available", blank).alias("scihub_available"), F.coalesce("downloaded", blank).alias("downloaded"),
        blank.alias("download_date"), F.coalesce("pymupdf_status", blank).alias("pymupdf_status"), blank.alias("pymupdf_date"),
        F.coalesce("grobid_status", blank).alias("grobid_status"), blank.alias("grobid_date"), F.lit("2024-01-01").alias("last_updated"),
        blank.alias("error_msg"), F.col("retry_count").cast("string").alias("retry_count"),
    )


OLD_FILE = """old AS (SELECT doi, coalesce(scihub_available, '') AS scihub_available, coalesce(downloaded, '') AS downloaded, '' AS download_date,
 coalesce(pymupdf_status, '') AS pymupdf_status, '' AS pymupdf_date, coalesce(grobid_status, '') AS grobid_status, '' AS grobid_date,
 '2024-01-01' AS last_updated, '' AS error_msg, CAST(retry_count AS VARCHAR) AS retry_count FROM tracker)"""


@query(
    "migrate_file", "tracker", "papers",
    sql=f"""
WITH {OLD_FILE}, p AS (SELECT doi, (full_text IS NOT NULL AND full_text <> '') OR (full_text_sections IS NOT NULL AND full_text_sections <> '') AS c,
 coalesce(trim(oa_url, {WS}) <> '', false) AS u FROM papers WHERE {HAS_DOI})
SELECT old.doi, scihub_available, downloaded AS scihub_downloaded, CASE WHEN u THEN 'yes' ELSE 'no' END AS oa_available, 'unknown' AS oa_downloaded, downloaded,
 download_date, CASE WHEN c THEN 'yes' ELSE 'no' END AS has_content_in_db, pymupdf_status, pymupdf_date, grobid_status, grobid_date, last_updated, error_msg, retry_count
FROM old LEFT JOIN p ON old.doi = p.doi""",
)
def migrate_file(spark, sf_dir):
    s = Source(spark, sf_dir)
    return ledger.migrate_file(_old_file(s), s.papers)


REBUILD = f"""
WITH {OLD_FILE}, p AS (SELECT doi, coalesce(trim(full_text, {WS}) <> '', false) OR coalesce(trim(full_text_sections, {WS}) <> '', false) AS c,
 coalesce(trim(oa_url, {WS}) <> '', false) AS u FROM papers WHERE {HAS_DOI}),
a AS (SELECT doi, bool_or(parser = 'pymupdf') AS f, bool_or(parser = 'grobid') AS g FROM {fixtures.with_doi('extractions', 'papers', 'tracker')} e GROUP BY doi),
k AS (SELECT doi FROM p UNION SELECT doi FROM old),
r AS (SELECT k.doi, coalesce(scihub_available, 'unknown') AS scihub_available, coalesce(downloaded, 'unknown') AS scihub_downloaded,
 CASE WHEN u THEN 'yes' ELSE 'no' END AS oa_available, 'unknown' AS oa_downloaded,
 CASE WHEN c AND coalesce(downloaded, 'unknown') = 'unknown' THEN 'yes' ELSE coalesce(downloaded, 'unknown') END AS downloaded,
 coalesce(download_date, '') AS download_date, CASE WHEN c THEN 'yes' ELSE 'no' END AS has_content_in_db,
 CASE WHEN f THEN 'success' ELSE coalesce(pymupdf_status, 'not_attempted') END AS pymupdf_status, coalesce(pymupdf_date, '') AS pymupdf_date,
 CASE WHEN g THEN 'success' ELSE coalesce(grobid_status, 'not_attempted') END AS grobid_status, coalesce(grobid_date, '') AS grobid_date,
 coalesce(last_updated, '2024-06-01') AS last_updated, coalesce(error_msg, '') AS error_msg, coalesce(retry_count, '0') AS retry_count, p.doi IS NOT NULL AS in_papers
 FROM k LEFT JOIN old ON k.doi = old.doi LEFT JOIN p ON k.doi = p.doi LEFT JOIN a ON k.doi = a.doi)
"""


def _rebuilt(s: Source):
    keys = inventory.with_doi(s.extractions.select("stem", "parser"), s.papers, s.tracker)
    return ledger.rebuild_file(_old_file(s), s.papers, keys, F.lit("2024-06-01"))


@query("rebuild_file", "tracker", "papers", "extractions", sql=REBUILD + "SELECT * FROM r")
def rebuild_file(spark, sf_dir):
    return _rebuilt(Source(spark, sf_dir))


PARTS = {
    "from_papers": "in_papers", "scihub_available": "scihub_available = 'yes'", "oa_available": "oa_available = 'yes'", "downloaded": "downloaded = 'yes'",
    "has_content": "has_content_in_db = 'yes'", "pymupdf_success": "pymupdf_status = 'success'", "grobid_success": "grobid_status = 'success'",
}


@query(
    "rebuild_statistics", "tracker", "papers", "extractions",
    sql=REBUILD + "SELECT *, " + ", ".join(f"round({n} * 100.0 / total, 1) AS {n}_pct" for n in PARTS)
    + " FROM (SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (WHERE {c}) AS {n}" for n, c in PARTS.items()) + " FROM r) x",
)
def rebuild_statistics(spark, sf_dir):
    return ledger.rebuild_statistics(_rebuilt(Source(spark, sf_dir)))
