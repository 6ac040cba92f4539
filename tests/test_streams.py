"""The ledger stream against the batch fold, file sources and sinks, revisions, routing and the work filter."""

import os
import random
import time
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpus_ledger import schemas
from corpus_ledger.operators import ledger
from corpus_ledger.session import cut_lineage
from corpus_ledger.sources import artefacts, files, sinks
from corpus_ledger.streaming import keeper
from corpus_ledger.streaming import ledger as stream

START = datetime(2024, 1, 1)


def random_events(n, seed, dois=6, hot=None):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rnd.choice(["download", "pymupdf", "grobid", "retry_increment", "retry_increment", "error", "update", "oa_available", "arxiv_download", "reset" if i % 9 == 0 else "error"])
        changes = None
        if kind == "update":
            changes = rnd.choice([{"downloaded": "no"}, {"retry_count": str(rnd.randrange(5))}, {"grobid_date": "2020-02-03 04:05:06", "error_msg": None}, {"retry_count": "x"}])
        doi = hot if hot and rnd.random() < 0.4 else f"d{rnd.randrange(dois)}"
        at = None if rnd.random() < 0.03 else START + timedelta(minutes=rnd.randrange(60 * 24))
        rows.append((i, doi, kind, None, rnd.choice(["success", "failed", "oa", "yes"]), rnd.choice([None, "", f"m{i}"]), at, changes))
    return rows


def as_text(df):
    return sorted(map(str, df.collect()))


def land(spark, rows, folder, part):
    spark.createDataFrame(rows, schemas.EVENTS).coalesce(1).write.parquet(f"{folder}/part={part}")


def run_ledger(spark, root, **options):
    query = keeper.start_ledger(stream.read_events(spark, f"{root}/events"), f"{root}/keeper", **options)
    query.awaitTermination()
    return query


@pytest.mark.parametrize("seed", [1, 2])
def test_merging_in_any_order(spark, seed):
    """Merging summaries of single events, in any order and grouping, is the fold."""
    rows = random_events(300, seed, hot="d0")
    frame = spark.createDataFrame(rows, schemas.EVENTS)
    wanted = as_text(ledger.fold(frame))
    single = [(r["doi"], keeper._plain(r)) for r in keeper.event_summaries(frame).collect()]
    for order in (1, 2):
        random.Random(order).shuffle(single)
        parts = [{}, {}, {}]
        for k, (doi, s) in enumerate(single):
            part = parts[k % 3]
            part[doi] = keeper.merged(part[doi], s) if doi in part else s
        total = {}
        for part in parts:
            for doi, s in part.items():
                total[doi] = keeper.merged(total[doi], s) if doi in total else s
        got = spark.createDataFrame([(doi, *s) for doi, s in total.items()], f"doi string, {keeper.SUMMARY}")
        assert as_text(keeper.ledger_of(got)) == wanted


@pytest.mark.parametrize("most", [2, 40, 1000])
def test_merging_by_columns(spark, most):
    """Summaries merged by columns, a few or many at a time, are those merged one by one; counts of settled steps too."""
    events = spark.createDataFrame(random_events(300, 4, hot="d0"), schemas.EVENTS)
    once = keeper.combined(keeper.event_summaries(events).coalesce(1), most)
    assert most < 1000 or once.count() == once.select("doi").distinct().count()
    rows = [(r["doi"], keeper._plain(r)) for r in once.collect()]
    rows += [(doi, keeper.settled_before(s, s[9])) for doi, s in rows[::2]]
    total = {}
    for doi, s in rows:
        total.setdefault(doi, []).append(s)
    got = keeper.combined(spark.createDataFrame([(doi, *s) for doi, s in rows], f"doi string, {keeper.SUMMARY}").coalesce(1))
    own = lambda s: (sorted(map(tuple, s[0])), sorted(map(tuple, s[1])), *s[2:])
    assert {r["doi"]: own(keeper._plain(r)) for r in got.collect()} == {doi: own(keeper.merged(*s)) for doi, s in total.items()}
    assert as_text(keeper.ledger_of(keeper.combined(keeper.event_summaries(events).coalesce(1)))) == as_text(ledger.fold(events))


def test_state_takes_one_row_of_a_doi_in_a_batch(spark, tmp_path, monkeypatch):
    class Single(keeper.Keeper):
        def handleInputRows(self, key, rows, timerValues):
            rows = list(rows)
            if len(rows) != 1:
                raise ValueError(f"{len(rows)} rows of a DOI")
            return super().handleInputRows(key, iter(rows), timerValues)

    monkeypatch.setattr(keeper, "Keeper", Single)
    rows = random_events(200, 5, hot="hot")
    for part in range(4):  # all in one batch
        land(spark, rows[part::4], f"{tmp_path}/events", part)
    run_ledger(spark, tmp_path)
    assert as_text(keeper.read_ledger(spark, f"{tmp_path}/keeper")) == as_text(ledger.fold(spark.createDataFrame(rows, schemas.EVENTS)))


def test_settled_steps(spark):
    s = keeper.merged(*[([], [(at, 1)], 0, keeper.BEFORE_ALL, None, None, None, None, None, at) for at in (10, 20)])
    s = keeper.merged(s, ([], [(30, 1)], 0, keeper.BEFORE_ALL, None, None, None, None, None, 30))
    s = keeper.settled_before(s, 20)
    assert (s[1], s[2], s[3]) == ([(30, 1)], 2, 20)

    def base(at):
        return ([], [], 0, keeper.BEFORE_ALL, None, None, at, 5, 0, at)

    assert keeper.merged(s, base(25))[1:3] == ([(30, 1)], 0)  # a reset after the settled steps takes them back
    assert keeper.merged(s, base(15))[1:3] == ([(30, 1)], 2)  # one that is too late does not
    assert keeper.merged(base(25), s)[1:3] == ([(30, 1)], 0)


def test_ledger_stream_equals_the_fold(spark, tmp_path):
    """Batches out of order, resets between, a restart, and steps that settle behind the watermark."""
    rows = random_events(200, 5, hot="hot")
    random.Random(3).shuffle(rows)
    sizes = []
    for part in range(2):
        land(spark, rows[part * 100 : part * 100 + 100], f"{tmp_path}/events", part)
        query = run_ledger(spark, tmp_path, lateness="2 days")
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        seen = spark.createDataFrame(rows[: part * 100 + 100], schemas.EVENTS)
        assert as_text(keeper.read_ledger(spark, f"{tmp_path}/keeper")) == as_text(ledger.fold(seen))
    before = keeper.state_size(spark, f"{tmp_path}/keeper").first()
    assert before["steps"] > 0 and before["settled"] == 0 and before["dois"] == 7 and sizes[1] >= 7
    # An event far ahead moves the watermark: all steps become counts, and the ledger stays as it is.
    late = (900, "other", "error", None, None, "m", START + timedelta(days=30), None)
    land(spark, [late], f"{tmp_path}/events", 9)
    run_ledger(spark, tmp_path, lateness="2 days")
    after = keeper.state_size(spark, f"{tmp_path}/keeper").first()
    assert after["steps"] == 0 and after["settled"] == before["steps"] and after["dois"] == 8
    every = spark.createDataFrame([*rows, late], schemas.EVENTS)
    wanted = as_text(ledger.fold(every))
    assert as_text(keeper.read_ledger(spark, f"{tmp_path}/keeper")) == wanted
    # An earlier state can be read too, and nothing new leaves the ledger as it is.
    assert keeper.read_ledger(spark, f"{tmp_path}/keeper", batch_id=0).count() <= 7
    run_ledger(spark, tmp_path, lateness="2 days")
    assert as_text(keeper.read_ledger(spark, f"{tmp_path}/keeper")) == wanted


def test_ledger_stream_from_a_table_with_changes(spark, tmp_path):
    """A ledger to begin with; each batch hands on the rows it changed."""
    first = spark.createDataFrame(random_events(60, 8, dois=4), schemas.EVENTS)
    base = cut_lineage(ledger.fold(first))
    rows = [(1, "d1", "reset", None, None, None, START + timedelta(days=2), None), (2, "new", "grobid", None, "success", None, START, None)]
    land(spark, rows, f"{tmp_path}/events", 0)
    changed = {}
    run_ledger(spark, tmp_path, base=base, on_change=lambda df, number: changed.setdefault(number, sorted(r["doi"] for r in df.collect())))
    assert [d for batch in changed.values() for d in batch] == ["d1", "new"]
    got = {r["doi"]: r for r in keeper.read_ledger(spark, f"{tmp_path}/keeper").collect()}
    old = {r["doi"]: r for r in base.collect()}
    assert got.keys() == old.keys() | {"new"}
    assert all(got[d] == old[d] for d in old if d != "d1")
    assert got["d1"]["retry_count"] == 0 and all(got["d1"][c] is None for c in schemas.TRACKER_COLUMNS) and got["new"]["grobid_status"] == "success"


def test_files_all_or_none(spark, tmp_path):
    rows = spark.range(300).selectExpr("concat('f', id, '.json') AS name", "repeat('x', cast(id AS int)) AS body")
    out = f"{tmp_path}/out"
    visible = lambda: sum(not f.startswith("_") for f in os.listdir(out))
    files.write_files(rows, f"file://{out}")
    assert {f: os.path.getsize(f"{out}/{f}") for f in os.listdir(out)} == {f"f{i}.json": i for i in range(300)}
    with pytest.raises(Exception, match="there already"):
        files.write_files(rows.limit(2).unionByName(spark.createDataFrame([("g.json", "y")], "name string, body string")), out)
    with pytest.raises(Exception, match="occurs twice"):
        files.write_files(spark.range(40).selectExpr("concat('z', id % 39) AS name", "'b' AS body"), out)
    boom = rows.withColumn("name", F.concat(F.lit("n"), "name")).withColumn("body", F.when(F.col("name") == "nf250.json", F.raise_error(F.lit("boom"))).otherwise(F.col("body")))
    with pytest.raises(Exception, match="boom"):
        files.write_files(boom, out)
    with pytest.raises(Exception, match="not a file name"):
        files.write_files(spark.createDataFrame([("ok", "b"), ("a/b", "b")], "name string, body string"), out)
    assert visible() == 300  # a failed job puts nothing in place
    files.write_files(spark.createDataFrame([("f3.json", None), ("new", "ü")], "name string, body string"), out, mode="overwrite")
    assert os.path.getsize(f"{out}/f3.json") == 0 and (tmp_path / "out/new").read_text() == "ü" and visible() == 301


def test_edges_read_only_the_ends(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, body in {"a.pdf": b"%PDF-" + b"x" * 100_000 + b"%%EOF", "B.PDF": b"%PDF-", "c.txt": b"no", "d.pdf": b""}.items():
        (tmp_path / "in" / name).write_bytes(body)
    got = {r["name"]: r for r in files.file_edges(spark, str(tmp_path / "in"), f"{tmp_path}/absent", pattern="*.pdf", head=5, tail=10, min_length=3).collect()}
    assert got.keys() == {"a.pdf", "B.PDF", "d.pdf"}
    assert bytes(got["a.pdf"]["tail"]) == b"xxxxx%%EOF" and got["a.pdf"]["bytes_read"] == 15 and got["a.pdf"]["dir"] == "in"
    assert bytes(got["B.PDF"]["head"]) == b"%PDF-" and got["d.pdf"]["head"] is None


def test_rewritten_files_come_again_once(spark, tmp_path):
    folder, root = tmp_path / "output", tmp_path
    folder.mkdir()
    known = spark.createDataFrame([("10.1/a_b",)], "doi string")

    def scan():
        time.sleep(0.02)
        stream.start_extraction_watch(spark, str(folder), known, f"{root}/events", f"{root}/watch", settle_ms=0).awaitTermination()
        rows = spark.read.schema(schemas.EVENTS).parquet(f"{root}/events").groupBy("doi").count().collect() if (root / "events").exists() else []
        return {r["doi"]: r["count"] for r in rows}

    (folder / "10.1_a_b.json").write_text("{}")
    (folder / "10.1_c_fast.json").write_text("{}")
    assert scan() == {"10.1/a_b": 1}
    assert scan() == {"10.1/a_b": 1}
    (folder / "10.1_a_b.json").write_text("{ }")
    (folder / "10.1_d.json").write_text("{}")
    assert scan() == {"10.1/a_b": 2, "10.1/d": 1}
    keeper.start_ledger(stream.read_events(spark, f"{root}/events"), f"{root}/keeper").awaitTermination()
    assert {r["doi"]: r["grobid_status"] for r in keeper.read_ledger(spark, f"{root}/keeper").collect()} == {"10.1/a_b": "success", "10.1/d": "success"}


def test_scans_meet_without_gap_or_overlap(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def scan(settle=0):
        return artefacts.Scan(spark, str(folder), f"{tmp_path}/marks", "*.json", settle)

    (folder / "a.json").write_text("1")
    time.sleep(0.02)
    one = scan()
    (folder / "b.json").write_text("1")  # lands after the mark was taken, before the listing
    assert [r["stem"] for r in one.files().collect()] == ["a"]
    assert [r["stem"] for r in one.files().collect()] == ["a"]
    one.done()
    time.sleep(0.02)
    two = scan()
    edge = two.before * 1_000_000
    (folder / "c.json").write_text("1")
    os.utime(folder / "c.json", ns=(edge, edge))  # written in the very millisecond of the mark
    assert [r["stem"] for r in two.files().collect()] == ["b"]
    assert [r["stem"] for r in scan().files().collect()] != []  # not done: the next scan begins at the same mark
    two.done()
    time.sleep(0.02)
    assert [r["stem"] for r in scan().files().collect()] == ["c"]


def test_late_rows_and_forgotten_keys(spark, tmp_path):
    root = str(tmp_path)
    hour = timedelta(hours=1)

    def batch(part, *rows):
        spark.createDataFrame([(d, None if h is None else START + h * hour) for d, h in rows], "doi string, at timestamp").coalesce(1).write.parquet(f"{root}/in/part={part}")
        rows = spark.readStream.schema("doi string, at timestamp").parquet(f"{root}/in")
        stream.start_routing(rows, "at", 2 * 3_600_000, f"{root}/routed", f"{root}/routing").awaitTermination()
        on_time = spark.readStream.schema("doi string, at timestamp").parquet(f"{root}/routed/on_time").select("doi", "at")
        query = stream.once_per_key(on_time, "doi", "at", "2 hours").writeStream.format("parquet").option("path", f"{root}/out")
        query = query.option("checkpointLocation", f"{root}/once").trigger(availableNow=True).start()
        query.awaitTermination()
        late = spark.read.schema("doi string, at timestamp").parquet(f"{root}/routed/late")
        return sorted(r["doi"] for r in spark.read.parquet(f"{root}/out").collect()), sorted(r["doi"] for r in late.collect()), query.lastProgress["stateOperators"][0]["numRowsTotal"]

    assert batch(0, ("a", 0), ("a", 1), ("b", 1), ("x", None))[:2] == (["a", "b"], ["x"])
    assert batch(1, ("a", 1), ("c", 4))[:2] == (["a", "b", "c"], ["x"])
    # The newest row is of hour 4: hour 2 is late now, hour 3 is not.
    assert batch(2, ("b", 2), ("d", 3))[:2] == (["a", "b", "c", "d"], ["b", "x"])
    kept, late, state = batch(3, ("z", 100))
    assert kept == ["a", "b", "c", "d", "z"] and state == 1  # keys behind the watermark are forgotten
    # The last batch runs again and splits alike.
    for name in ("3", ".3.crc"):
        (tmp_path / "routing/commits" / name).unlink()
    stream.start_routing(spark.readStream.schema("doi string, at timestamp").parquet(f"{root}/in"), "at", 7_200_000, f"{root}/routed", f"{root}/routing").awaitTermination()
    assert spark.read.parquet(f"{root}/routed/on_time").count() == 7


def test_work_filter_judges_a_batch_once(spark, tmp_path):
    """Identifier batches start at 0 whatever the ledger's batch, and a batch that runs again sees the same ledger."""
    root, out = str(tmp_path), f"{tmp_path}/work"

    def finish(part, *dois):
        land(spark, [(part * 10 + k, d, "grobid", None, "success", None, START + timedelta(hours=part), None) for k, d in enumerate(dois)], f"{root}/events", part)
        run_ledger(spark, root)

    def listed(*new):
        if new:
            spark.createDataFrame([(d,) for d in new], "doi string").coalesce(1).write.mode("append").parquet(f"{root}/ids")
        stream.start_work_filter(spark.readStream.schema("doi string").parquet(f"{root}/ids"), f"{root}/keeper", out, f"{root}/filter").awaitTermination()
        return {v: sorted(r["doi"] for r in spark.read.parquet(f"{out}/version={v}").collect()) for v in range(sinks.latest_version(spark, out) + 1)}

    assert keeper.newest_batch(spark, f"{root}/keeper") == -1
    assert listed("a", "q") == {0: ["a", "q"]}  # no ledger yet
    finish(1, "a", "b")
    finish(2, "c")
    assert listed("a", "b", "c", "d") == {0: ["a", "q"], 1: ["d"]}
    finish(3, "d")
    for name in ("1", ".1.crc"):  # batch 1 was not committed and runs again
        (tmp_path / "filter/commits" / name).unlink()
    assert listed() == {0: ["a", "q"], 1: ["d"]}
    assert listed("d", "e") == {0: ["a", "q"], 1: ["d"], 2: ["e"]}


def test_files_of_a_large_folder_leave_nothing_on_the_driver(spark, tmp_path, monkeypatch):
    """The driver neither lists nor moves files, and the number of tasks does not grow with the number of files."""
    out, n = f"{tmp_path}/output", 3000
    driver = os.getpid()
    calls = []
    real = files.names_in
    monkeypatch.setattr(files, "names_in", lambda *a: calls.append(os.getpid()) or real(*a))
    rows = spark.range(n).selectExpr("concat('10.1_', id) AS stem", "if(id % 2 = 0, 'grobid', 'pymupdf') AS parser", "concat('{\"n\": ', id, '}') AS body")
    sinks.write_documents(rows, out)
    assert sorted(os.listdir(out)) == sorted(f"10.1_{i}{'_fast' * (i % 2)}.json" for i in range(n))
    most = files.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    edges = files.file_edges(spark, out, pattern="*.json", head=1, tail=1)
    for found in (artefacts.list_extractions(spark, out), artefacts.read_extractions(spark, out), edges):
        assert found.count() == n and found.rdd.getNumPartitions() <= most
    read = {r["stem"]: (r["parser"], r["dir"], r["length"], r["body"]) for r in artefacts.read_extractions(spark, out).collect()}
    assert read == {f"10.1_{i}": ("pymupdf" if i % 2 else "grobid", "output", len(f'{{"n": {i}}}'), f'{{"n": {i}}}') for i in range(n)}
    assert driver not in calls


def test_listings_as_sparks_readers_give_them(spark, tmp_path):
    """Files without content, hidden ones and other names are no rows; names are those of the files, and text is not re-coded."""
    folder = tmp_path / "in put"
    folder.mkdir()
    for name, body in {"a b%20.json": b'"\xff"', "b_fast.json": b"{}", "empty.json": b"", "_c.json": b"{}", ".d.json": b"{}", "e.JSON": b"{}", "f.Pdf": b"%PDF-"}.items():
        (folder / name).write_bytes(body)
    (folder / "g.json").mkdir()
    assert {(r["stem"], r["dir"], r["parser"], r["length"]) for r in artefacts.list_extractions(spark, str(folder)).collect()} == {
        ("a b%20", "in put", "grobid", 3), ("b", "in put", "pymupdf", 2)
    }
    body = artefacts.read_extractions(spark, str(folder)).filter("parser = 'grobid'").select(F.col("body").cast("binary").alias("b")).first()["b"]
    assert bytes(body) == b'"\xff"'
    assert [r["stem"] for r in artefacts.list_pdfs(spark, f"file://{folder}").collect()] == ["f"]
    stamp = os.stat(folder / "f.Pdf").st_mtime_ns // 1_000_000
    assert artefacts.list_pdfs(spark, str(folder)).select(F.unix_millis("modificationTime")).first()[0] == stamp
    with pytest.raises(Exception, match="no folder"):
        artefacts.list_extractions(spark, f"{folder}/none")


def test_a_move_that_runs_again_finds_its_file(tmp_path):
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b"]), pa.array(["p", "p"])], names=["name", "place"])
    (tmp_path / "_s" / "p").mkdir(parents=True)
    for name in "ab":
        (tmp_path / "_s" / "p" / name).write_text(name)
    for _ in range(2):
        assert [b.column(0).to_pylist() for b in files._moved(str(tmp_path), "_s")(iter([batch]))] == [[2]]
    assert (tmp_path / "a").read_text() == "a" and (tmp_path / "b").read_text() == "b"
    (tmp_path / "b").unlink()
    with pytest.raises(FileNotFoundError):
        list(files._moved(str(tmp_path), "_s")(iter([batch])))


def test_revisions_are_dealt_to_tasks_of_bounded_number(spark, tmp_path):
    for i in range(700):
        (tmp_path / f"{i}.json").write_text("{}")
    reader = files.RevisionReader({"path": str(tmp_path), "pattern": "*.json", "settlems": "0", "parts": "3"})
    time.sleep(0.02)
    end = reader.latestOffset()
    parts = reader.partitions({"after": -1}, end)
    rows = [n for p in parts for batch in reader.read(p) for n in batch.column(1).to_pylist()]
    assert len(parts) == 3 and sorted(rows) == sorted(f"{i}.json" for i in range(700))
    assert reader.latestOffset() == end  # nothing new: the offset stays
    time.sleep(0.02)
    (tmp_path / "5.json").write_text("{ }")
    time.sleep(0.02)
    after = reader.latestOffset()
    rows = [n for p in reader.partitions(end, after) for batch in reader.read(p) for n in batch.column(1).to_pylist()]
    assert rows == ["5.json"]
