"""Sources, sinks, snapshots, numbering and streams on files in a scratch folder."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpus_ledger import schemas
from corpus_ledger.operators import extraction, gaps, inventory, numbering, reports
from corpus_ledger.sources import artefacts, lists, logs, sinks, tables
from corpus_ledger.streaming import ledger as stream


def write(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in files.items():
        (folder / name.replace("__", ".")).write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(folder)


def test_identifier_lists(spark, tmp_path):
    folder = write(tmp_path, a__txt="10.1/x\n\n  10.2/y \n# note\n10.1/x\n", b__txt="10.3/z\n")
    paths = [f"{folder}/a.txt", f"{folder}/absent.txt", f"{folder}/b.txt"]
    rows = lists.read_identifiers(spark, *paths).orderBy("path", "pos").collect()
    assert [r["identifier"] for r in rows] == ["10.1/x", "10.2/y", "# note", "10.1/x", "10.3/z"]
    got = {r["doi"] for r in lists.read_identifier_set(spark, *paths, comments=True).collect()}
    assert got == {"10.1/x", "10.2/y", "10.3/z"}
    assert lists.read_identifiers(spark, f"{folder}/absent.txt").count() == 0


PDF = b"%PDF-" + b"x" * 2000 + b"%%EOF"


def test_artefact_scans(spark, tmp_path):
    out = write(tmp_path / "output", **{"10.1_a__json": json.dumps({"metadata": {"title": "abcdef"}}), "10.1_a_fast__json": "{bad", "10.1_b_fast__json": "{}"})
    rows = {(r["stem"], r["parser"], r["dir"]) for r in artefacts.list_extractions(spark, out).collect()}
    assert rows == {("10.1_a", "grobid", "output"), ("10.1_a", "pymupdf", "output"), ("10.1_b", "pymupdf", "output")}
    read = {(r["stem"], r["parser"]): (r["length"], r["body"]) for r in artefacts.read_extractions(spark, out).collect()}
    assert read["10.1_a", "pymupdf"] == (4, "{bad")
    plan = artefacts.list_extractions(spark, out)._jdf.queryExecution().executedPlan().toString()
    assert "content#" not in plan.split("ReadSchema")[-1]
    primary = write(tmp_path / "papers", **{"10.1_a__pdf": PDF, "10.1_b__PDF": b"%PDF-short", "c__txt": "x"})
    other = write(tmp_path / "pdfs", **{"10.1_a__pdf": PDF + b"y", "10.1_d__pdf": b"z" * 3000})
    checked = {(r["dir"], r["stem"]): r["is_valid"] for r in artefacts.checked_pdfs(spark, primary, other).collect()}
    assert checked == {("papers", "10.1_a"): True, ("papers", "10.1_b"): False, ("pdfs", "10.1_a"): True, ("pdfs", "10.1_d"): False}
    listed = artefacts.list_pdfs(spark, primary, other)
    assert listed.count() == 4
    assert artefacts.newer_than(listed, F.lit("1970-01-01").cast("timestamp")).count() == 4
    assert artefacts.newer_than(listed, F.lit("2999-01-01").cast("timestamp")).count() == 0


def test_tracker_files(spark, tmp_path):
    head1 = "doi,scihub_available,downloaded,download_date,pymupdf_status,pymupdf_date,grobid_status,grobid_date,last_updated,error_msg,retry_count\n"
    folder = write(tmp_path, v1__csv=head1 + '10.1/x,yes,no,,failed,,not_attempted,,2024,"a ""b"", c",2\n')
    old = tables.read_tracker_file(spark, f"{folder}/v1.csv")
    row = old.first()
    assert (row["download_date"], row["error_msg"], row["retry_count"]) == ("", 'a "b", c', "2")
    new = spark.createDataFrame([], schemas.TRACKER_FILE_V2)
    both = tables.union_tracker_files(old, new)
    assert both.first()["oa_available"] is None and len(both.columns) == 15
    sinks.write_tracker_file(old, f"{folder}/out")
    assert tables.read_tracker_file(spark, f"{folder}/out").first()["error_msg"] == 'a "b", c'
    assert tables.status_of(old, "10.1/x").count() == 1 and tables.status_of(old, "10.9/x").count() == 0


LOG = """intro
DOI/Identifier: 10.1/a
Timestamp: 2024-01-01 10:00:00
Worker: 1
Result: success
Parser: PyMuPDF
----
DOI/Identifier: 10.1/b
Timestamp: 2024-01-01 11:00:00
Result: not_found
DOI/Identifier: 10.1/c
Timestamp: 2024-01-01 12:00:00
no outcome
DOI/Identifier: 10.1/a  Timestamp: 2024-01-02 09:00:00 Result: processing_failed Parser: grobid
"""


def test_logs(spark, tmp_path):
    rule = "=" * 80
    current = f"\n{rule}\nDOI: 10.1/q\nOriginal: doi:10.1/q\nStatus: success\nTimestamp: 2024-03-01 00:00:00\n\n{rule}\nDOI: 10.1/r\nStatus: NOT FOUND (all)\n\n{rule}\nSUMMARY\n{rule}\nTotal: 2\n"
    folder = write(tmp_path, a__log=LOG, b__log=current)
    got = [(r["doi"], r["ts"], r["result"], r["parser"]) for r in logs.read_logs(spark, [f"{folder}/a.log"]).orderBy("pos").collect()]
    assert got[:2] == [("10.1/a", "2024-01-01 10:00:00", "success", "PyMuPDF"), ("10.1/b", "2024-01-01 11:00:00", "not_found", None)]
    rows = logs.read_current_logs(spark, [f"{folder}/b.log"]).orderBy("pos").collect()
    assert [(r["doi"], r["result"], r["ts"]) for r in rows] == [("10.1/q", "success", "2024-03-01 00:00:00"), ("10.1/r", "NOT FOUND (all)", "")]


def test_batches(spark, tmp_path):
    df = spark.range(0, 1000).select(F.format_string("k%05d", F.col("id")).alias("doi")).repartition(7)
    rows = numbering.in_batches(df, 64, "doi").orderBy("rn").collect()
    assert [r["rn"] for r in rows] == list(range(1, 1001)) and [r["doi"] for r in rows] == [f"k{i:05d}" for i in range(1000)]
    assert (rows[-1]["batch_name"], rows[63]["batch"], rows[64]["batch"]) == ("batch_16_of_16", 1, 2)
    sinks.write_batches(df, f"{tmp_path}/batches", 300, "doi")
    sizes = {r["batch_name"]: r["n"] for r in spark.read.text(f"{tmp_path}/batches").groupBy("batch_name").agg(F.count("*").alias("n")).collect()}
    assert sizes == {"batch_1_of_4": 300, "batch_2_of_4": 300, "batch_3_of_4": 300, "batch_4_of_4": 100}
    assert numbering.in_batches(df.limit(0), 10, "doi").count() == 0


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "doi string")
    path = sinks.write_stamped(df, str(tmp_path / "lists"), "20240101_000000")
    parts = spark.read.text(path).select("value", "_metadata.file_name").orderBy("file_name").collect()
    assert [r["value"] for r in parts] == ["a", "b", "c"]
    results = spark.createDataFrame([("x", "success"), ("y", "not_found"), ("z", "not_found")], "identifier string, status string")
    sinks.write_report(results, f"{tmp_path}/report")
    assert sorted(r["value"] for r in spark.read.text(f"{tmp_path}/report/retry").collect()) == ["y", "z"]
    assert spark.read.json(f"{tmp_path}/report/by_status").groupBy("status").count().count() == 2
    sinks.write_results_json(results, f"{tmp_path}/json", "now")
    assert spark.read.json(f"{tmp_path}/json/statistics").count() == 2
    sinks.write_results_csv(results, f"{tmp_path}/csv")
    assert spark.read.csv(f"{tmp_path}/csv", header=True).count() == 3
    bodies = spark.createDataFrame([("s", "grobid", '{"a": 1}')], "stem string, parser string, body string")
    sinks.write_documents(bodies, f"{tmp_path}/docs")
    sinks.write_quarantine(bodies, f"{tmp_path}/quarantine")
    sinks.write_raw_markup(spark.createDataFrame([(1, "<TEI/>")], "doc_id long, tei string"), f"{tmp_path}/tei")
    sinks.append_events(spark.createDataFrame([], schemas.EVENTS), f"{tmp_path}/events")
    assert (tmp_path / "docs/s.json").read_text() == '{"a": 1}' and (tmp_path / "tei/1.tei.xml").read_text() == "<TEI/>"
    sinks.write_stage_lists(spark.createDataFrame([("download", "b"), ("download", "a"), ("grobid", "a")], "stage string, doi string"), f"{tmp_path}/stages")
    assert sorted(r["value"] for r in spark.read.text(f"{tmp_path}/stages/stage=download").collect()) == ["a", "b"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_results_csv(results, f"{tmp_path}/csv")


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "table")
    assert sinks.read_snapshot(spark, root) is None
    for version in (0, 1, 1):
        sinks.write_snapshot(spark.range(version + 1), root, version)
    assert sinks.latest_version(spark, root) == 1 and sinks.latest_version(spark, root, below=1) == 0
    assert sinks.read_snapshot(spark, root).count() == 2


def test_first_keys_limits_before_the_shuffle(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("kind"), F.format_string("%06d", "id").alias("doi"))
    out = reports.first_keys(df, "kind", 3)
    assert [(r["kind"], r["doi"]) for r in out.orderBy("kind", "rank").collect()] == [
        ("hot", "000001"), ("hot", "000002"), ("hot", "000003"), ("rare", "000000"), ("rare", "000010"), ("rare", "000020"),
    ]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_work_streams(spark, tmp_path):
    folder = f"{tmp_path}/evaluations"
    papers = spark.createDataFrame([("1", "a", None, "s"), ("2", "b", "x", "s"), ("3", "c", "x", None)], "pmid string, doi string, abstract string, full_text_sections string")
    rows = [[("a", "valid", None), ("b", "valid", None), ("c", "not_valid", 8.0)], [("a", "doubted", 1.0), ("c", "not_valid", 7.0), ("", "valid", None)]]
    for part in rows:
        spark.createDataFrame(part, schemas.EVALUATIONS).coalesce(1).write.mode("append").parquet(folder)
        stream.start_work_list(stream.read_new_evaluations(spark, folder), papers, f"{tmp_path}/work", f"{tmp_path}/checkpoint").awaitTermination()
    assert sorted(r["doi"] for r in spark.read.parquet(f"{tmp_path}/work").collect()) == ["a", "c"]


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    sides = [
        tables.write_bucketed(spark.range(100).select(F.col("id").cast("string").alias("doi"), F.lit(n).alias("v")), n, f"{tmp_path}/{n}", 4)
        for n in ("left_t", "right_t")
    ]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for joined in (sides[0].join(sides[1], "doi"), gaps.select_keys(sides[0], sides[1])):
            assert joined.count() == 100
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan.replace("BroadcastExchange", "")
        some = tables.read_keyed(sides[0], ["7", "none"], ["doi"])
        assert [r["doi"] for r in some.collect()] == ["7"] and tables.read_keyed(sides[0], []).count() == 0
        one = tables.read_keyed(sides[0], ["7"], ["doi"])
        one.collect()
        plan = one._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert "EqualTo(doi,7)" in plan.split("PushedFilters: [")[1].split("]")[0]
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else buckets do not show in the plan
        one = tables.read_keyed(sides[0], ["7"], ["doi"])._jdf.queryExecution()
        plan = one.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert "SelectedBucketsCount: 1 out of 4" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        spark.sql("DROP TABLE left_t")
        spark.sql("DROP TABLE right_t")


def test_numbering_runs_nothing_until_asked(spark):
    """No job runs while the plan is built; ties, repeated rows, NULLs and any number of ranges are numbered in order."""
    rows = [(None if i % 40 == 0 else "hot" if i % 3 == 0 else f"k{i * 7919 % 500:03d}", i % 50) for i in range(600)]
    df = spark.createDataFrame(rows, "doi string, x int").repartition(5)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("numbering", "plan only")
    for bits in (0, 1, 4, 10):
        numbered = numbering.with_row_number(df, "doi", "x", bits=bits)
        assert not jobs.getJobIdsForGroup("numbering")
        assert "Checkpoint" not in numbered._jdf.queryExecution().executedPlan().toString()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        got = sorted((r["rn"], r["doi"], r["x"], r["total"]) for r in numbered.collect())
        assert [g[0] for g in got] == list(range(1, 601)) and {g[3] for g in got} == {600}
        assert [g[1:3] for g in got] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
        spark.sparkContext.setJobGroup("numbering", "plan only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_routes_leave_one_scan(spark, tmp_path):
    good = json.dumps({"metadata": {"title": "abcdef"}, "full_text": {"body": [{"title": "t", "content": "x" * 60}]}})
    source = f"{tmp_path}/bodies"
    spark.createDataFrame([("a", "grobid", good), ("b", "grobid", "{bad"), ("c", "pymupdf", "{}")], "stem string, parser string, body string").selectExpr(
        "stem", "parser", "cast(octet_length(body) AS bigint) AS length", "body"
    ).write.parquet(source)
    routed = inventory.routed(spark.read.parquet(source))
    assert routed._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    sinks.write_routed(routed, f"{tmp_path}/routed")
    sides = {side: {r["stem"]: r["reason"] for r in spark.read.parquet(f"{tmp_path}/routed/route={side}").collect()} for side in ("usable", "quarantine")}
    assert sides["usable"] == {"a": None} and sides["quarantine"].keys() == {"b", "c"} and sides["quarantine"]["b"] == "Invalid JSON"


def test_results_are_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def status(x):
        seen.add(1)
        return x

    rows = [("a", "success"), ("b", "success"), ("c", "not_found"), ("d", "processing_failed")]
    df = spark.createDataFrame(rows, "identifier string, status string").withColumn("status", status("status"))
    sinks.write_results_json(df, f"{tmp_path}/known", "now")
    assert seen.value == 4
    stats = {r["status"]: r["papers"] for r in spark.read.json(f"{tmp_path}/known/statistics").collect()}
    assert stats == {"success": 2, "not_found": 1, "processing_failed": 1}
    other = spark.createDataFrame([*rows, ("e", "odd"), ("f", None)], "identifier string, status string")
    sinks.write_results_json(other, f"{tmp_path}/other", "now")
    stats = {r.asDict().get("status"): r["papers"] for r in spark.read.schema("status string, papers bigint").json(f"{tmp_path}/other/statistics").collect()}
    assert stats == {"success": 2, "not_found": 1, "processing_failed": 1, "odd": 1, None: 1}


def test_extraction_goes_on_where_it_stopped(spark, tmp_path):
    folder = write(tmp_path / "in", **{f"10.1_{i:02d}__pdf": ("bad" if i == 4 else "nothing" if i == 7 else f"text {i}") for i in range(12)})
    pending = spark.createDataFrame([(f"10.1_{i:02d}", f"{folder}/10.1_{i:02d}.pdf") for i in range(12)] + [("10.1_99", f"{folder}/none.pdf")], "stem string, path string")
    calls = f"{tmp_path}/calls"

    def extract(frame, mode):
        with open(calls, "a") as f:
            f.writelines(f"{s}\n" for s in frame["stem"])
        if (frame["content"] == b"bad").any():
            raise ValueError("broken")
        kept = frame[frame["content"] != b"nothing"]
        return pd.DataFrame({"stem": kept["stem"], "body": [mode + c.decode() for c in kept["content"]]})

    out = f"{tmp_path}/run"
    extraction.plan(pending, out, 5)
    assert extraction.results(spark, out).count() == 0
    assert not extraction.run_batches(spark, extract, out, "simple", stop_after=1)
    assert sorted((r["batch"], r["files"], r["done"]) for r in extraction.progress(spark, out).collect()) == [(1, 5, True), (2, 5, False), (3, 3, False)]
    # A batch that was cut off while writing is not done, and is written anew.
    (tmp_path / "run/results/batch=2").mkdir()
    (tmp_path / "run/results/batch=2/part-half.parquet").write_text("torn")
    before = open(calls).read()
    extraction.plan(pending.limit(0), out, 1)  # the stored plan stays
    assert extraction.run_batches(spark, extract, out, "simple")
    assert extraction.run_batches(spark, extract, out, "simple")
    assert "10.1_00\n" in before and "10.1_00\n" not in open(calls).read().removeprefix(before)
    got = {r["stem"]: (r["status"], r["error"], r["body"]) for r in extraction.results(spark, out).collect()}
    assert len(got) == 13 and got["10.1_03"] == ("success", None, "simpletext 3") and got["10.1_07"] == ("failed", None, None)
    assert got["10.1_04"] == ("error", "ValueError: broken", None) and got["10.1_99"][0] == "error"
    assert {r["mode"] for r in extraction.results(spark, out).collect()} == {"simple"}
    with pytest.raises(ValueError, match="unknown mode"):
        extraction.extracted(pending, extract, "loud")
    limited = f"{tmp_path}/limited"
    extraction.plan(pending, limited, 5, limit=3)
    assert extraction.progress(spark, limited).agg(F.sum("files")).first()[0] == 3
