"""Ledger events, upserts, views and resets on small literal ledgers."""

from datetime import datetime

from pyspark.sql import functions as F

from corpus_ledger import schemas
from corpus_ledger.operators import gaps, inventory, ledger, merge, planning, reconcile

AT = F.lit("2024-06-01 00:00:00").cast("timestamp")


def t(n):
    return datetime(2024, 1, 1, 0, 0, n)


def events(spark, *rows):
    """Rows are (doi, event_type, status_to, message, changes); time and id grow."""
    full = [(i, d, e, None, to, m, t(i), ch) for i, (d, e, to, m, ch) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.EVENTS)


def folded(spark, *rows, **kw):
    return {r["doi"]: r.asDict() for r in ledger.fold(events(spark, *rows), **kw).collect()}


def test_download_events(spark):
    got = folded(
        spark,
        ("a", "download", "scihub", None, None), ("b", "download", "oa", None, None), ("c", "download", "success", None, None),
        ("d", "download", "failed", None, None), ("e", "download", "unknown_source", None, None), ("f", "download", "openalex", None, None),
        ("g", "arxiv_attempted", None, None, None), ("g", "arxiv_download", "failed", None, None), ("h", "unpaywall_download", "success", None, None),
    )
    assert (got["a"]["downloaded"], got["a"]["download_source"], got["a"]["scihub_downloaded"], got["a"]["oa_downloaded"]) == ("yes", "scihub", "yes", None)
    assert (got["b"]["oa_downloaded"], got["b"]["download_date"]) == ("yes", t(1))
    assert (got["c"]["downloaded"], got["c"]["download_source"]) == ("yes", None)
    assert (got["d"]["downloaded"], got["d"]["download_date"]) == ("no", t(3))
    assert (got["e"]["downloaded"], got["e"]["download_source"]) == ("yes", None)
    assert got["f"]["download_source"] == "openalex"
    assert (got["g"]["arxiv_attempted"], got["g"]["arxiv_downloaded"], got["g"]["downloaded"]) == ("yes", "no", None)
    assert (got["h"]["unpaywall_downloaded"], got["h"]["download_source"], got["h"]["download_date"]) == ("yes", "unpaywall", t(8))


def test_flags_parsers_and_errors(spark):
    got = folded(
        spark,
        ("a", "scihub_available", "no", None, None), ("a", "oa_available", "yes", None, None), ("a", "pymupdf", "success", None, None),
        ("a", "pymupdf", "failed", "boom", None), ("a", "grobid", "success", None, None), ("a", "error", None, "later", None),
    )["a"]
    assert (got["scihub_available"], got["oa_available"]) == ("no", "yes")
    assert (got["pymupdf_status"], got["pymupdf_date"], got["grobid_status"]) == ("failed", t(3), "success")
    assert (got["error_msg"], got["last_updated"], got["retry_count"]) == ("later", t(5), 0)


def test_file_ledger_counts_errors_as_retries(spark):
    rows = [("a", "pymupdf", "failed", "x", None), ("a", "grobid", "failed", "y", None), ("a", "grobid", "failed", None, None)]
    assert folded(spark, *rows)["a"]["retry_count"] == 0
    assert folded(spark, *rows, errors_count=True)["a"]["retry_count"] == 2


def test_reset_and_retries(spark):
    got = folded(
        spark,
        ("a", "download", "oa", None, None), ("a", "retry_increment", None, None, None), ("a", "reset", None, None, None),
        ("a", "retry_increment", None, None, None), ("a", "grobid", "failed", None, None), ("b", "reset", None, None, None),
        ("c", "update", None, None, {"retry_count": "5", "downloaded": "yes"}), ("c", "retry_increment", None, None, None),
        ("c", "update", None, None, {"downloaded": None, "grobid_date": "2024-02-03 00:00:00"}),
    )
    assert (got["a"]["downloaded"], got["a"]["grobid_status"], got["a"]["retry_count"]) == (None, "failed", 1)
    assert (got["b"]["retry_count"], got["b"]["last_updated"]) == (0, t(5))
    assert (got["c"]["retry_count"], got["c"]["downloaded"], got["c"]["grobid_date"]) == (6, None, datetime(2024, 2, 3))


def test_one_hot_doi(spark):
    """A third of all events on one DOI are counted right."""
    n, reset_at = 20_000, 9_999
    hot = spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id"))).alias("doi"),
        F.when(F.col("id") == reset_at, "reset").otherwise("retry_increment").alias("event_type"),
        F.lit(None).cast("string").alias("status_to"), F.timestamp_seconds(F.col("id")).alias("created_at"),
    )
    want = sum(1 for i in range(n) if i % 3 == 0 and i > reset_at)
    rows = ledger.fold(hot)
    assert rows.count() == 1 + n - len(range(0, n, 3))
    assert {r["doi"]: r["retry_count"] for r in rows.filter("doi in ('hot', 'd1')").collect()} == {"hot": want, "d1": 1}


def test_known_stems_are_not_turned_back(spark):
    """A DOI with an underscore keeps its file; only files no DOI claims have theirs read back."""
    known = tracker(spark, **{"10.1_x": {"grobid_status": "success"}})
    known = known.withColumn("doi", F.lit("10.1/a_b"))
    files = spark.createDataFrame([("10.1_a_b", "grobid"), ("10.2_c_d", "grobid"), ("10.2_c_d_fast", "pymupdf")], "stem string, parser string")
    assert [r["doi"] for r in reconcile.structured_scan(files, known).collect()] == ["10.2/c/d"]
    seeds = reconcile.seeds_from_files(files.limit(1), files.select("stem").limit(0), known)
    assert seeds.collect() == []
    two = known.unionByName(known.withColumn("doi", F.lit("10.1/a/b")))
    got = inventory.with_doi(files, two).filter("stem = '10.1_a_b'").collect()
    assert sorted(r["doi"] for r in got) == ["10.1/a/b", "10.1/a_b"]


def test_pmid_merge_keeps_rows(spark):
    """Papers that share a pmid are changed alike and never multiplied; blank pmids are left alone."""
    papers = spark.createDataFrame(
        [("1", "10.1/a", "", None, None), ("1", "10.1/b", "has", "", None), ("", None, None, None, None), (None, None, None, None, None)],
        "pmid string, doi string, abstract string, full_text string, full_text_sections string",
    ).withColumns({"title": F.lit("t"), "parsing_status": F.lit(None).cast("string"), "oa_url": F.lit("u")})
    fetched = spark.createDataFrame(
        [("1", "A", "T", "[]"), ("1", "B", None, None), ("", "x", "y", "[]"), (None, "x", "y", "[]")],
        "pmid string, abstract string, full_text string, full_text_sections string",
    )
    changes = merge.fetched_changes(papers, fetched)
    assert [tuple(r) for r in changes.collect()] == [("1", "A", "T", "[]")]
    after = merge.apply_changes(papers, changes, "pmid")
    assert after.count() == 4
    assert {(r["doi"], r["full_text"]) for r in after.filter("pmid = '1'").collect()} == {("10.1/a", "T"), ("10.1/b", "T")}


def test_lookup_of_papers_without_pmid(spark):
    papers = spark.createDataFrame([(None, "10.1/a", "u1"), ("5", "10.1/b", "u2"), (None, "10.1/b", "u3")], "pmid string, doi string, oa_url string")
    got = gaps.oa_lookup(papers.select("doi"), papers).collect()
    assert {(r["doi"], r["oa_url"]) for r in got} == {("10.1/a", "u1"), ("10.1/b", "u2")}


TRACKER_ROW = dict.fromkeys(schemas.TRACKER_COLUMNS)


def tracker(spark, **by_doi):
    rows = [
        tuple({"doi": d.replace("_", "/"), **TRACKER_ROW, "last_updated": t(0), "retry_count": 0, **v}.values()) for d, v in by_doi.items()
    ]
    return spark.createDataFrame(rows, schemas.TRACKER)


def test_upsert(spark):
    base = tracker(spark, a={"downloaded": "no", "grobid_status": "failed", "retry_count": 2}, b={"downloaded": "yes"})
    new = spark.createDataFrame(
        [("a", "yes", 1), ("a", None, 2), ("c", "unknown", 1), (None, "yes", 1), ("", "yes", 1)], "doi string, downloaded string, seq int"
    )
    got = {r["doi"]: r for r in ledger.upsert(base, new, AT, seq="seq").collect()}
    assert set(got) == {"a", "b", "c"}
    assert (got["a"]["downloaded"], got["a"]["grobid_status"], got["a"]["retry_count"]) == (None, "failed", 2)
    assert (got["b"]["downloaded"], got["b"]["last_updated"]) == ("yes", t(0))
    assert (got["c"]["downloaded"], got["c"]["retry_count"], got["c"]["last_updated"]) == ("unknown", 0, datetime(2024, 6, 1))


def test_patch_keeps_columns(spark):
    base = tracker(spark, a={"downloaded": "yes", "retry_count": 4})
    new = spark.createDataFrame([("a", None, "failed")], "doi string, downloaded string, grobid_status string")
    row = ledger.patch(base, new, AT).first()
    assert (row["downloaded"], row["grobid_status"], row["retry_count"]) == ("yes", "failed", 4)


def test_reset_creates_rows(spark):
    base = tracker(spark, a={"downloaded": "yes", "retry_count": 4}, b={"downloaded": "yes"})
    keys = spark.createDataFrame([("a",), ("z",), ("a",)], "doi string")
    got = {r["doi"]: (r["downloaded"], r["retry_count"]) for r in ledger.reset(base, keys, AT).collect()}
    assert got == {"a": (None, 0), "b": ("yes", 0), "z": (None, 0)}


EXHAUSTED = {
    "scihub_available": "no", "oa_downloaded": "no", "arxiv_attempted": "yes", "biorxiv_attempted": "yes",
    "europepmc_attempted": "yes", "unpaywall_attempted": "yes", "downloaded": "no",
}


def test_partition_rungs(spark):
    base = tracker(
        spark,
        **{
            "10.1_spent": {**EXHAUSTED, "retry_count": 1, "pymupdf_status": "success"},
            "10.1_spent0": {**EXHAUSTED, "retry_count": 0},
            "10.1_nodl": {**EXHAUSTED, "downloaded": None, "retry_count": 3},
            "10.1_done": {"pymupdf_status": "success"},
            "10.1_fail2": {"pymupdf_status": "failed", "retry_count": 2},
            "10.1_fail1": {"pymupdf_status": "failed", "retry_count": 1, "downloaded": "yes"},
            "10.1_lost": {"downloaded": "yes"},
            "10.1_gdone": {"grobid_status": "success"},
        },
    )
    files = spark.createDataFrame(
        [("10.1_fail1", True, True, False), ("10.1_new", True, False, False), ("10.1_both", True, True, True), ("10.1_json", False, True, True)],
        "stem string, has_pdf boolean, has_pymupdf boolean, has_grobid boolean",
    )
    ids = [
        "10.1/spent", "10.1/spent0", "10.1/nodl", "10.1/done", "10.1/fail2", "10.1/fail1", "10.1/lost", "10.1/gdone", "doi:10.1/done",
        "10.1/new", "10.1/both", "https://doi.org/10.1/both", "10.1/json", "10.1/absent", "junk", "junk",
    ]
    listed = spark.createDataFrame([(i,) for i in ids], "identifier string")
    got = {r["identifier"]: (r["bucket"], r["n_listed"]) for r in planning.partition_work(listed, base, files, "fast").collect()}
    download, parse, done, skip = ("needs_download", 1), ("needs_parse_only", 1), ("complete", 1), ("skipped_failed", 1)
    assert got == {
        "10.1/spent": skip, "10.1/spent0": download, "10.1/nodl": download, "10.1/done": done, "10.1/fail2": skip, "10.1/fail1": parse,
        "10.1/lost": download, "10.1/gdone": download, "doi:10.1/done": download, "10.1/new": parse, "10.1/both": done,
        "https://doi.org/10.1/both": done, "10.1/json": download, "10.1/absent": download, "junk": ("needs_download", 2),
    }
    structured = {r["identifier"]: r["bucket"] for r in planning.partition_work(listed, base, files, "grobid").collect()}
    assert structured["10.1/gdone"] == "complete" and structured["10.1/done"] == "needs_download"
    assert structured["10.1/spent"] == "skipped_failed" and structured["10.1/fail1"] == "needs_parse_only"


def test_example_scenarios(spark):
    """Five typical papers: parsed, open access, exhausted, parse failed, parse pending."""
    base = tracker(
        spark,
        **{
            "10.1_a": {"scihub_available": "yes", "downloaded": "yes", "pymupdf_status": "success", "grobid_status": "not_attempted"},
            "10.1_b": {"oa_available": "yes", "downloaded": "yes", "pymupdf_status": "success", "grobid_status": "success"},
            "10.1_c": {**EXHAUSTED, "retry_count": 3},
            "10.1_d": {"downloaded": "yes", "pymupdf_status": "failed", "retry_count": 1},
            "10.1_e": {"downloaded": "yes", "pymupdf_status": "not_attempted", "grobid_status": "not_attempted"},
        },
    )
    steps = {r["doi"]: r["next_step"] for r in ledger.next_step(base).collect()}
    assert steps == {
        "10.1/a": "Process with Grobid", "10.1/b": "Fully processed", "10.1/c": "Download PDF", "10.1/d": "Process with Grobid", "10.1/e": "Process with PyMuPDF",
    }
    assert {(r["category"], r["doi"]) for r in ledger.retryable(base).collect()} == {("pymupdf", "10.1/d")}
    assert {(r["category"], r["doi"]) for r in ledger.retryable(base, 4).collect()} == {("download", "10.1/c"), ("pymupdf", "10.1/d")}
    stats = ledger.statistics(base).first()
    assert (stats["total_dois"], stats["fully_processed"], stats["completion_pct"], stats["scihub_unknown"]) == (5, 2, 40.0, 3)
    pending = {(r["stage"], r["doi"]) for r in ledger.pending_by_stage(base).collect()}
    assert pending == {("grobid", "10.1/a"), ("pymupdf", "10.1/d"), ("pymupdf", "10.1/e"), ("grobid", "10.1/e")}


def test_waterfall(spark):
    rows = [
        ("a", "unpaywall", True), ("a", "arxiv", False), ("a", "semanticscholar", True), ("b", "arxiv", False), ("b", "biorxiv", False),
        ("c", "oa_direct", True), ("c", "arxiv", True), ("d", "unknown", True),
    ]
    got = {r["doi"]: r for r in planning.waterfall(spark.createDataFrame(rows, "doi string, source string, ok boolean")).collect()}
    assert got["a"]["source"] == "unpaywall" and got["a"]["arxiv_downloaded"] == "no" and got["a"]["unpaywall_downloaded"] == "yes"
    assert got["b"]["source"] is None and got["b"]["oa_available"] == "no" and got["b"]["biorxiv_attempted"] == "yes"
    assert got["c"]["source"] == "oa_direct" and got["c"]["arxiv_attempted"] is None
    assert "d" not in got


def test_rebuild_keeps_colliding_stems_apart(spark):
    """Two DOIs that share a stem stay two rows; a file no paper claims is read back."""
    papers = spark.createDataFrame([("1", "10.1/a_b", "x"), ("2", "10.1/a/b", None)], "pmid string, doi string, abstract string")
    for c in ("full_text", "full_text_sections", "oa_url"):
        papers = papers.withColumn(c, F.lit(None).cast("string"))
    files = spark.createDataFrame([("10.1_a_b", "grobid"), ("10.9_z", "pymupdf")], "stem string, parser string")
    pdfs = spark.createDataFrame([("papers", "10.1_a_b")], "dir string, stem string")
    got = {r["doi"]: (r["has_content_in_db"], r["grobid_status"], r["downloaded"]) for r in reconcile.rebuild(papers, files, pdfs, AT).collect()}
    assert got == {"10.1/a_b": ("yes", "success", "yes"), "10.1/a/b": ("no", "success", "yes"), "10.9/z": ("no", None, None)}


def test_run_results(spark):
    plan = spark.createDataFrame(
        [("a", "10/a", 1, "complete"), ("b", "10/b", 1, "skipped_failed"), ("c", "10/c", 1, "needs_parse_only"), ("d", "10/d", 1, "needs_download"),
         ("e", "10/e", 1, "needs_download"), ("f", None, 2, "needs_download"), ("g", "10/g", 1, "needs_download")],
        "identifier string, doi string, n_listed long, bucket string",
    )
    downloads = spark.createDataFrame([("10/d", "success"), ("10/e", "failed"), ("10/g", "manual")], "doi string, download_status string")
    parses = spark.createDataFrame([("10/c", "success"), ("10/d", "failed"), ("10/g", "error")], "doi string, outcome string")
    got = {r["identifier"]: (r["status"], r["download_status"], r["parsing_status"]) for r in planning.run_results(plan, downloads, parses).collect()}
    assert got == {
        "a": ("skipped_complete", "skipped_exists", "skipped_exists"), "b": ("skipped_failed", "skipped_unavailable", "skipped_failed"),
        "c": ("success", "skipped_exists", "success"), "d": ("processing_failed", "success", "failed"), "e": ("not_found", "failed", None),
        "f": ("invalid_identifier", "skipped", "skipped"), "g": ("processing_failed", "manual", "error"),
    }
