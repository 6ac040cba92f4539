"""Round trips: written with a sink, read back with the source, compared with what went in."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from .. import fixtures
from ..operators import gaps, inventory
from ..session import scratch_folder
from ..sources import artefacts, files, lists, logs, sinks, tables
from .artefact_queries import PDF_VALID, VALID
from .gap_queries import HAS_DOI, WS
from .ledger_queries import OLD_FILE, _old_file
from .registry import Source, query

# A list has one identifier per line, so a line break in one is written as a space.
ONE_LINE = "replace(identifier, chr(10), ' ')"


@query(
    "list_lines", "id_list",
    sql=f"SELECT trim({ONE_LINE}, {WS}) AS identifier, count(*) AS n FROM id_list WHERE trim({ONE_LINE}, {WS}) <> '' GROUP BY 1",
)
def list_lines(spark, sf_dir):
    """Identifier list with repeats, of two files and one that is missing."""
    path = scratch_folder(spark)
    rows = Source(spark, sf_dir).id_list.withColumn("identifier", F.expr(ONE_LINE))
    for k in range(2):
        rows.filter(F.col("pos") % 2 == k).select(F.col("identifier").alias("value")).write.text(f"{path}/{k}")
    read = lists.read_identifiers(spark, f"{path}/0", f"{path}/1", f"{path}/2")
    return read.groupBy("identifier").agg(F.count(F.lit(1)).alias("n"))


@query("sorted_list", "papers", sql=f"SELECT doi AS identifier, row_number() OVER (ORDER BY doi) AS place FROM papers WHERE {HAS_DOI}")
def sorted_list(spark, sf_dir):
    """A stamped list: read back by file name and place, its lines are in order."""
    root = scratch_folder(spark)
    path = sinks.write_stamped(gaps.keyed(Source(spark, sf_dir).papers), root, "2024-06-01")
    lines = spark.read.text(path).select(
        F.col("value").alias("identifier"), F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("id")
    )
    # Files sort by name; places within a file follow the reader. Both are counted, so nothing is sorted by value.
    in_file = lines.select("identifier", "file", "id", F.col("id").bitwiseAND(F.lit((1 << 33) - 1)).alias("line"))
    sizes = in_file.groupBy("file").agg(F.count(F.lit(1)).alias("size"), F.min("line").alias("first")).collect()
    before, total = [], 0
    for r in sorted(sizes, key=lambda r: r["file"]):
        before.append((r["file"], total - r["first"]))
        total += r["size"]
    offsets = spark.createDataFrame(before, "file string, before bigint")
    return in_file.join(F.broadcast(offsets), "file").select("identifier", (F.col("line") + F.col("before") + 1).alias("place"))


@query("tracker_file", "tracker", sql=f"WITH {OLD_FILE} SELECT * FROM old")
def tracker_file(spark, sf_dir):
    path = f"{scratch_folder(spark)}/tracker"
    sinks.write_tracker_file(_old_file(Source(spark, sf_dir)), path)
    return tables.read_tracker_file(spark, path, version=1)


@query("point_lookup", "tracker", sql="SELECT * FROM tracker WHERE doi = (SELECT max(doi) FROM tracker)")
def point_lookup(spark, sf_dir):
    """One key's row, for the last key of the table."""
    tracker = Source(spark, sf_dir).tracker
    return tables.status_of(tracker, tracker.agg(F.max("doi")).first()[0] or "")


def _bucketed(spark, df, name):
    root = scratch_folder(spark)
    return tables.write_bucketed(df, f"{name}_{root.rsplit('-', 1)[-1]}", f"{root}/{name}", 8)


@query("tracker_rows", "tracker", "papers", sql=f"SELECT t.* FROM tracker t WHERE doi IN (SELECT doi FROM papers WHERE {HAS_DOI})")
def tracker_rows(spark, sf_dir):
    """Tracker and paper table in equal buckets, joined where they lie; the paper table through its reader."""
    s = Source(spark, sf_dir)
    path = f"{scratch_folder(spark)}/papers"
    s.papers.drop("parsing_status").write.parquet(path)
    papers = tables.read_papers(spark, path, ["doi", "parsing_status"]).filter("parsing_status IS NULL")
    # Papers without a DOI match nothing and would share a bucket.
    return gaps.select_keys(_bucketed(spark, s.tracker, "tracker"), _bucketed(spark, gaps.keyed(papers), "papers"))


@query(
    "keyed_scan", "tracker",
    sql="SELECT doi, downloaded, retry_count FROM tracker WHERE doi IN ((SELECT max(doi) FROM tracker), (SELECT min(doi) FROM tracker), 'no such doi')",
)
def keyed_scan(spark, sf_dir):
    """Rows of given keys out of a bucketed table."""
    tracker = Source(spark, sf_dir).tracker
    ends = tracker.agg(F.max("doi").alias("a"), F.min("doi").alias("b")).first()
    keys = [k for k in (ends["a"], ends["b"], "no such doi") if k]
    return tables.read_keyed(_bucketed(spark, tracker, "tracker"), keys, ["doi", "downloaded", "retry_count"])


@query("evaluation_table", "evaluations", sql="SELECT doi, result, CAST(confidence_score AS DOUBLE) AS confidence_score FROM evaluations")
def evaluation_table(spark, sf_dir):
    path = f"{scratch_folder(spark)}/evaluations"
    Source(spark, sf_dir).evaluations.write.parquet(path)
    return tables.read_evaluations(spark, path)


@query("log_files", "run_log", sql="SELECT doi, ts, result, parser, file_ord FROM run_log")
def log_files(spark, sf_dir):
    """Two logs as text, split at the marker by the reader."""
    path = scratch_folder(spark)
    blocks = fixtures.run_log_blocks(spark, sf_dir)
    for k in range(2):
        text = blocks.filter(F.col("file_ord") == k).select(F.concat(F.lit(logs.MARKER), "block").alias("value"))
        text.write.option("lineSep", "\n").text(f"{path}/{k}")
    return logs.read_logs(spark, [f"{path}/0", f"{path}/1"]).select("doi", "ts", "result", "parser", "file_ord")


@query(
    "document_files", "extractions",
    sql="SELECT stem, parser, 'output' AS dir, CAST(strlen(coalesce(text, '')) AS BIGINT) AS length FROM extractions",
)
def document_files(spark, sf_dir):
    """One file per extraction, and the listing of the folder: names and sizes."""
    path = f"{scratch_folder(spark)}/output"
    sinks.write_documents(Source(spark, sf_dir).extractions.select("stem", "parser", F.col("text").alias("body")), path)
    return artefacts.list_extractions(spark, path).select("stem", "parser", "dir", "length")


@query(
    "document_files_read", "extractions", "papers", "tracker",
    sql=f"SELECT doi, string_agg(parser, ',' ORDER BY parser) AS parsers FROM {fixtures.with_doi('extractions', 'papers', 'tracker')} e WHERE {VALID} GROUP BY doi",
)
def document_files_read(spark, sf_dir):
    """Extractions written as files, read back whole and validated: the parsers of each paper."""
    s = Source(spark, sf_dir)
    path = f"{scratch_folder(spark)}/output"
    sinks.write_documents(s.bodies, path)
    keys = inventory.valid_parsers(artefacts.read_extractions(spark, path), s.papers, s.tracker)
    return inventory.parser_sets(keys).select("doi", F.array_join("parsers", ",").alias("parsers"))


TEI_BYTES = "SELECT doc_id, n_chars % 19 <> 0 AS closed FROM documents"


@query("markup_files", sql=TEI_BYTES)
def markup_files(spark, sf_dir):
    """One markup file per document; their last bytes, by ranged reads, tell which are closed."""
    path = f"{scratch_folder(spark)}/tei"
    sinks.write_raw_markup(fixtures.tei_documents(spark, sf_dir), path)
    edges = files.file_edges(spark, path, pattern="*.tei.xml", head=5, tail=6)
    closed = (F.col("head") == F.lit(b"<TEI ")) & (F.col("tail") == F.lit(b"</TEI>"))
    return edges.select(F.substring_index("name", ".", 1).cast("long").alias("doc_id"), closed.alias("closed"))


LENGTH = "CAST(5 + strlen(coalesce(text, '')) + CASE WHEN n_chars % 7 = 0 THEN 0 ELSE 5 END + n_chars % 6000 AS BIGINT)"


@query(
    "pdf_scan",
    sql=f"""SELECT stem, dir, length, is_valid, CASE WHEN length < 1024 THEN 0 ELSE 5 + least(length, 4096) END AS bytes_read
FROM (SELECT {fixtures.STEM} AS stem, CASE WHEN doc_id % 3 = 0 THEN 'pdfs' ELSE 'papers' END AS dir, {LENGTH} AS length, {PDF_VALID} AS is_valid FROM documents WHERE text IS NOT NULL) x""",
)
def pdf_scan(spark, sf_dir):
    """PDF files in two folders, validated by their two ends only."""
    root = scratch_folder(spark)
    pdfs = fixtures.pdf_files(spark, sf_dir).filter("content IS NOT NULL").withColumn("name", F.concat("stem", F.lit(".PDF")))
    for k, folder in enumerate(("pdfs", "papers")):
        files.write_files(pdfs.filter((F.col("doc_id") % 3 == 0) == (k == 0)), f"{root}/{folder}", body="content")
    return artefacts.checked_pdfs(spark, f"{root}/pdfs", f"{root}/papers").select("stem", "dir", "length", "is_valid", "bytes_read")


@query(
    "pdf_inventory",
    sql=f"""SELECT stem, dir, length FROM (SELECT {fixtures.STEM} AS stem, unnest(['papers', 'pdfs']) AS dir, doc_id, {LENGTH} AS length FROM documents WHERE text IS NOT NULL) x
WHERE dir = 'papers' AND doc_id % 4 <> 0 OR dir = 'pdfs' AND doc_id % 3 <> 0""",
)
def pdf_inventory(spark, sf_dir):
    """PDF files of two folders, some in both, by name, folder and size; their contents are not read."""
    root = scratch_folder(spark)
    pdfs = fixtures.pdf_files(spark, sf_dir).filter("content IS NOT NULL")
    for folder, some, suffix in (("papers", "doc_id % 4 <> 0", ".pdf"), ("pdfs", "doc_id % 3 <> 0", ".Pdf")):
        files.write_files(pdfs.filter(some).withColumn("name", F.concat("stem", F.lit(suffix))), f"{root}/{folder}", body="content")
    return artefacts.list_pdfs(spark, f"{root}/papers", f"{root}/pdfs").select("stem", "dir", "length")


@query(
    "files_since_scan", "extractions",
    sql="""SELECT stem, parser, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 2 END AS scan FROM extractions
UNION ALL SELECT stem, parser, 2 AS scan FROM extractions WHERE doc_id % 3 = 0 AND doc_id % 2 = 0""",
)
def files_since_scan(spark, sf_dir):
    """Two scans with a kept mark: a third of the files before the first; the rest, and half of that third rewritten, before the second."""
    root = scratch_folder(spark)
    rows = Source(spark, sf_dir).extractions.select("doc_id", "stem", "parser", F.col("state").alias("body"))
    found = []
    for k, some in enumerate(("doc_id % 3 = 0", "doc_id % 3 <> 0 OR doc_id % 2 = 0"), 1):
        sinks.write_documents(rows.filter(some), f"{root}/output", "overwrite")
        time.sleep(0.05)
        scan = artefacts.Scan(spark, f"{root}/output", f"{root}/marks", "*.json", settle_ms=0)
        out = f"{root}/scan={k}"
        scan.files().select("stem", "parser", F.lit(k).alias("scan")).write.parquet(out)
        scan.done()
        found.append(out)
    return spark.read.parquet(*found)


@query("results_csv", "run_results", sql="SELECT identifier, status, mode, seconds FROM run_results")
def results_csv(spark, sf_dir):
    path = f"{scratch_folder(spark)}/results"
    sinks.write_results_csv(Source(spark, sf_dir).run_results.select("identifier", "status", "mode", "seconds"), path)
    return spark.read.csv(path, header=True, escape='"', schema="identifier string, status string, mode string, seconds double")


@query(
    "results_json", "run_results",
    sql="SELECT r.identifier, r.status, s.papers, '2024-06-01' AS timestamp FROM run_results r JOIN (SELECT status, count(*) AS papers FROM run_results GROUP BY status) s ON r.status = s.status",
)
def results_json(spark, sf_dir):
    path = scratch_folder(spark)
    sinks.write_results_json(Source(spark, sf_dir).run_results, path, "2024-06-01")
    results = spark.read.schema("identifier string, status string").json(f"{path}/results")
    return results.join(spark.read.schema("status string, papers bigint, timestamp string").json(f"{path}/statistics"), "status")


@query("event_table", "ledger_events", sql="SELECT id, doi, event_type, status_to, message, created_at FROM ledger_events")
def event_table(spark, sf_dir):
    """The audit events, appended in two runs."""
    path = f"{scratch_folder(spark)}/events"
    events = Source(spark, sf_dir).ledger_events
    for k in range(2):
        sinks.append_events(events.filter(F.col("id") % 2 == k), path)
    return spark.read.parquet(path).select("id", "doi", "event_type", "status_to", "message", "created_at")


@query("status_folders", "run_results", sql="SELECT identifier, status FROM run_results")
def status_folders(spark, sf_dir):
    path = f"{scratch_folder(spark)}/by_status"
    sinks.write_by_status(Source(spark, sf_dir).run_results, path)
    return spark.read.schema("identifier string, status string").json(path)
