"""Work partitioning, waterfalls, batches and run reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..operators import inventory, numbering, planning, reports
from .artefact_queries import normalized
from .gap_queries import HAS_DOI, NO_ABSTRACT, NO_SECTIONS
from .registry import Source, query

EXHAUSTED = """downloaded = 'no' AND (coalesce(scihub_available, '') = 'no' OR coalesce(scihub_downloaded, '') = 'no')
 AND (coalesce(oa_available, '') = 'no' OR coalesce(oa_downloaded, '') = 'no')
 AND arxiv_attempted = 'yes' AND biorxiv_attempted = 'yes' AND europepmc_attempted = 'yes' AND unpaywall_attempted = 'yes'"""
PLAN_VIEWS = ("id_list", "papers", "tracker", "extractions", "pdfs")


def plan_sql(parser: str) -> str:
    return f"""
WITH l AS (SELECT identifier, count(*) AS n_listed FROM (SELECT identifier FROM id_list UNION ALL SELECT doi FROM papers WHERE {HAS_DOI}) x GROUP BY 1),
d AS ({normalized('l')}),
f AS (SELECT stem, bool_or(k = 'pdf') AS pdf, bool_or(k = '{parser}') AS json FROM
 (SELECT stem, 'pdf' AS k FROM pdfs WHERE length > 0 AND dir = 'papers' UNION ALL SELECT stem, parser FROM extractions) u GROUP BY stem),
j AS (SELECT d.identifier, d.doi, l.n_listed, {parser}_status AS st, downloaded = 'yes' AS dl, retry_count AS rc, coalesce(pdf, false) AS pdf, coalesce(json, false) AS json,
 coalesce({EXHAUSTED}, false) AS ex
 FROM d JOIN l ON d.identifier = l.identifier LEFT JOIN tracker t ON d.identifier = t.doi LEFT JOIN f ON replace(d.doi, '/', '_') = f.stem),
plan AS (SELECT identifier, doi, n_listed, CASE WHEN ex AND rc >= 1 THEN 'skipped_failed' WHEN st = 'success' THEN 'complete' WHEN st = 'failed' AND rc >= 2 THEN 'skipped_failed'
 WHEN dl AND pdf THEN 'needs_parse_only' WHEN dl THEN 'needs_download' WHEN doi IS NULL THEN 'needs_download' WHEN NOT pdf THEN 'needs_download' WHEN NOT json THEN 'needs_parse_only' ELSE 'complete' END AS bucket FROM j)
"""


def plan_of(spark, sf_dir, parser: str):
    s = Source(spark, sf_dir)
    listed = s.id_list.select("identifier").unionByName(s.papers.filter("doi <> ''").select(F.col("doi").alias("identifier")))
    files = inventory.presence_by_stem(s.pdfs, s.presence)
    return planning.partition_work(listed, s.tracker, files, parser)


@query("partition_work_fast", *PLAN_VIEWS, sql=plan_sql("pymupdf") + "SELECT * FROM plan")
def partition_work_fast(spark, sf_dir):
    return plan_of(spark, sf_dir, "fast")


@query("partition_work_structured", *PLAN_VIEWS, sql=plan_sql("grobid") + "SELECT * FROM plan")
def partition_work_structured(spark, sf_dir):
    return plan_of(spark, sf_dir, "grobid")


@query(
    "partition_sizes", *PLAN_VIEWS,
    sql=plan_sql("pymupdf") + "SELECT bucket, count(*) AS identifiers, CAST(sum(n_listed) AS BIGINT) AS listed FROM plan GROUP BY bucket",
)
def partition_sizes(spark, sf_dir):
    return planning.partition_sizes(plan_of(spark, sf_dir, "fast"))


@query("exhausted", "tracker", sql=f"SELECT doi, retry_count FROM tracker WHERE {EXHAUSTED}")
def exhausted(spark, sf_dir):
    return Source(spark, sf_dir).tracker.filter(planning.exhausted()).select("doi", "retry_count")


RANK = "list_position([" + ", ".join(f"'{s}'" for s in planning.SOURCE_ORDER) + "], source)"
ORDER = "[" + ", ".join(f"'{s}'" for s in planning.SOURCE_ORDER) + "]"
WATERFALL = f"""
WITH a AS (SELECT *, {RANK} AS r FROM attempts), w AS (SELECT doi, min(r) FILTER (WHERE ok) AS win FROM a GROUP BY doi),
reach AS (SELECT w.doi, w.win, {', '.join(f"bool_or(a.ok) FILTER (WHERE a.source = '{s}' AND (w.win IS NULL OR a.r <= w.win)) AS {s}" for s in planning.TRACKED_SOURCES)}
 FROM w JOIN a ON w.doi = a.doi GROUP BY w.doi, w.win),
fall AS (SELECT doi, CASE WHEN win IS NOT NULL THEN {ORDER}[win] END AS source, win IS NOT NULL AS found,
 {', '.join(f"CASE WHEN {s} IS NOT NULL THEN 'yes' END AS {s}_attempted, CASE WHEN {s} THEN 'yes' WHEN {s} IS NOT NULL THEN 'no' END AS {s}_downloaded" for s in planning.TRACKED_SOURCES)},
 CASE WHEN win IS NOT NULL THEN 'yes' ELSE 'no' END AS oa_available FROM reach)
"""


@query("waterfall_pick", "attempts", sql=WATERFALL + "SELECT * FROM fall")
def waterfall_pick(spark, sf_dir):
    return planning.waterfall(Source(spark, sf_dir).attempts)


RESOLVED = WATERFALL + f""", pr AS (SELECT doi, bool_or(status_to = 'scihub') AS ok FROM ledger_events WHERE event_type = 'download' GROUP BY doi),
man AS (SELECT DISTINCT doi FROM {fixtures.with_doi('pdfs', 'papers')} f WHERE dir = 'pdfs'),
res AS (SELECT w.doi, CASE WHEN pr.ok THEN 'primary' WHEN fall.found THEN fall.source WHEN man.doi IS NOT NULL THEN 'manual' END AS download_source
 FROM (SELECT DISTINCT doi FROM papers WHERE {HAS_DOI} AND ({NO_ABSTRACT} OR {NO_SECTIONS})) w LEFT JOIN pr ON w.doi = pr.doi LEFT JOIN fall ON w.doi = fall.doi LEFT JOIN man ON w.doi = man.doi),
resolved AS (SELECT *, CASE WHEN download_source IS NULL THEN 'failed' WHEN download_source = 'manual' THEN 'manual' ELSE 'success' END AS download_status,
 CAST(download_source IS NULL AS INT) AS retry_step FROM res)
"""
RESOLVE_VIEWS = ("attempts", "ledger_events", "pdfs", "papers")


def _resolved(s: Source):
    from ..operators import gaps

    work = gaps.keyed(s.papers).filter(gaps.missing_abstract_or_sections()).select("doi")
    primary = s.ledger_events.filter("event_type = 'download'").select("doi", (F.col("status_to") == "scihub").alias("ok"))
    manual = inventory.with_doi(s.pdfs.filter("dir = 'pdfs'").select("stem"), s.papers)
    return planning.resolve_downloads(work, primary, planning.waterfall(s.attempts), manual)


@query("resolve_downloads", *RESOLVE_VIEWS, sql=RESOLVED + "SELECT * FROM resolved")
def resolve_downloads(spark, sf_dir):
    return _resolved(Source(spark, sf_dir))


@query(
    "run_result_status", *PLAN_VIEWS, "attempts", "ledger_events", "run_results",
    sql=RESOLVED.replace("\nWITH a AS", plan_sql("pymupdf") + ", a AS", 1)
    + """, parses AS (SELECT identifier AS doi, CASE status WHEN 'success' THEN 'success' WHEN 'processing_failed' THEN 'failed' ELSE 'error' END AS outcome FROM run_results),
x AS (SELECT plan.*, r.download_status AS rd, p.outcome FROM plan LEFT JOIN resolved r ON plan.doi = r.doi LEFT JOIN parses p ON plan.doi = p.doi),
y AS (SELECT *, bucket = 'needs_download' AND doi IS NULL AS invalid FROM x),
z AS (SELECT identifier, doi, n_listed, bucket, invalid, CASE WHEN bucket IN ('complete', 'needs_parse_only') THEN 'skipped_exists' WHEN bucket = 'skipped_failed' THEN 'skipped_unavailable' WHEN invalid THEN 'skipped' ELSE coalesce(rd, 'failed') END AS download_status,
 CASE WHEN bucket = 'complete' THEN 'skipped_exists' WHEN bucket = 'skipped_failed' THEN 'skipped_failed' WHEN invalid THEN 'skipped'
  WHEN bucket = 'needs_download' AND (rd IS NULL OR rd = 'failed') THEN NULL ELSE coalesce(outcome, 'failed') END AS parsing_status FROM y)
SELECT identifier, doi, n_listed, bucket, download_status, parsing_status, 'fast' AS parser_used,
 CASE WHEN bucket = 'complete' THEN 'skipped_complete' WHEN bucket = 'skipped_failed' THEN 'skipped_failed' WHEN invalid THEN 'invalid_identifier'
  WHEN parsing_status IS NULL THEN 'not_found' WHEN parsing_status = 'success' THEN 'success' ELSE 'processing_failed' END AS status FROM z""",
)
def run_result_status(spark, sf_dir):
    s = Source(spark, sf_dir)
    outcome = F.when(F.col("status") == "success", "success").when(F.col("status") == "processing_failed", "failed").otherwise("error")
    parses = s.run_results.select(F.col("identifier").alias("doi"), outcome.alias("outcome"))
    return planning.run_results(plan_of(spark, sf_dir, "fast"), _resolved(s), parses)


@query(
    "batches", "tracker",
    sql="""SELECT doi, rn, CAST(floor((rn - 1) / 64) AS BIGINT) + 1 AS batch, CAST(ceil(n / 64.0) AS BIGINT) AS n_batches,
 'batch_' || (CAST(floor((rn - 1) / 64) AS BIGINT) + 1) || '_of_' || CAST(ceil(n / 64.0) AS BIGINT) AS batch_name
FROM (SELECT doi, row_number() OVER (ORDER BY doi) AS rn, count(*) OVER () AS n FROM tracker) x""",
)
def batches(spark, sf_dir):
    return numbering.in_batches(Source(spark, sf_dir).tracker.select("doi"), 64, "doi")


@query(
    "run_summary", "run_results",
    sql="""SELECT count(*) AS total, count(*) FILTER (WHERE status = 'success') AS success, count(*) FILTER (WHERE status = 'skipped_complete') AS skipped_complete,
 count(*) FILTER (WHERE status = 'skipped_failed') AS skipped_failed, count(*) FILTER (WHERE status = 'not_found') AS not_found, count(*) FILTER (WHERE status = 'processing_failed') AS failed FROM run_results""",
)
def run_summary(spark, sf_dir):
    return reports.run_summary(Source(spark, sf_dir).run_results)


@query(
    "run_report", "run_results",
    sql="SELECT status, count(*) AS papers, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM run_results GROUP BY status",
)
def run_report(spark, sf_dir):
    return reports.run_report(Source(spark, sf_dir).run_results)


@query("retry_list", "run_results", sql="SELECT identifier FROM run_results WHERE status = 'not_found'")
def retry_list(spark, sf_dir):
    return reports.retry_list(Source(spark, sf_dir).run_results)


@query("failed_files", "run_results", sql="SELECT identifier, status FROM run_results WHERE status <> 'success'")
def failed_files(spark, sf_dir):
    return reports.failed_files(Source(spark, sf_dir).run_results)


@query(
    "mode_timing", "run_results",
    sql="""SELECT mode, count(*) AS papers, count(*) FILTER (WHERE status = 'success') AS successful, round(avg(seconds) FILTER (WHERE status = 'success'), 4) AS avg_seconds
FROM run_results GROUP BY mode""",
)
def mode_timing(spark, sf_dir):
    return reports.timing_by_mode(Source(spark, sf_dir).run_results)


@query(
    "status_distribution", "papers",
    sql="SELECT parsing_status, coalesce(nullif(parsing_status, ''), 'NULL/Empty') AS shown_as, count(*) AS papers FROM papers GROUP BY 1 ORDER BY papers DESC",
)
def status_distribution(spark, sf_dir):
    return reports.status_distribution(Source(spark, sf_dir).papers)


@query(
    "top_samples", "papers", "tracker",
    sql=f"""SELECT presence, CAST(rank AS INT) AS rank, doi FROM (SELECT *, row_number() OVER (PARTITION BY presence ORDER BY doi) AS rank FROM (
 SELECT coalesce(p.doi, t.doi) AS doi, CASE WHEN t.doi IS NULL THEN 'only_papers' WHEN p.doi IS NULL THEN 'only_tracker' ELSE 'both' END AS presence
 FROM (SELECT DISTINCT doi FROM papers WHERE {HAS_DOI}) p FULL JOIN (SELECT DISTINCT doi FROM tracker) t ON p.doi = t.doi) x) y WHERE rank <= 10""",
)
def top_samples(spark, sf_dir):
    from ..operators import gaps

    s = Source(spark, sf_dir)
    return reports.first_keys(gaps.presence(s.papers, s.tracker), "presence", 10)


@query(
    "update_run_status", "run_results", "tracker",
    sql="""SELECT identifier, CASE WHEN t.error THEN 'error' WHEN NOT t.d THEN 'failed_download' WHEN NOT t.p THEN 'failed_processing' WHEN NOT t.u THEN 'failed_update' ELSE 'success' END AS status
FROM run_results r JOIN (SELECT doi, retry_count = 3 AND pymupdf_status IS NULL AS error, coalesce(downloaded = 'yes', false) AS d, coalesce(pymupdf_status IN ('success', 'failed'), false) AS p, has_content_in_db = 'yes' AS u FROM tracker) t ON r.identifier = t.doi""",
)
def update_run_status(spark, sf_dir):
    s = Source(spark, sf_dir)
    t = s.tracker
    joined = s.run_results.select("identifier").join(t, F.col("identifier") == F.col("doi"))
    status = planning.update_run_status(
        F.coalesce(F.col("downloaded") == "yes", F.lit(False)), F.coalesce(F.col("pymupdf_status").isin("success", "failed"), F.lit(False)),
        F.col("has_content_in_db") == "yes", F.when((F.col("retry_count") == 3) & F.col("pymupdf_status").isNull(), F.lit("boom")),
    )
    return joined.select("identifier", status.alias("status"))
