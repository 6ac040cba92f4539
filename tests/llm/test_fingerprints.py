"""Threshold-scaled sketches against sets built in plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from corpus_ledger.llm import fingerprints as fp
from tests.llm.common import frame

def test_edit_order_and_digest(spark):
    rows = [(3, "abcdefghi"), (7, "xyz"), (1, None), (5, "ééééééé!!"), (2, "")]
    got = {r["doc_id"]: r for r in fp.document_fingerprints(frame(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        t, after = t or "", after or ""
        k = len(t) // 3
        want = t[: len(t) - k] + after[:k]
        assert got[i]["n_chars"] == len(t)
        assert got[i]["edited_sha256"] == hashlib.sha256(want.encode()).hexdigest()


def test_equal_texts_repeated_rows_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(1, long), (1, long), (2, long), (None, "a b"), (3, " \t "), (4, "x " * 3000)]
    got = fp.document_fingerprints(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    same = {r["fingerprint"] for r in got if r["doc_id"] in (1, 2)}
    assert len(same) == 1 and same != {""}
    assert [r["fingerprint"] for r in got if r["doc_id"] == 3] == [""]
    two = next(r for r in got if r["doc_id"] == 2)
    assert two["near_next"] == 1.0


@pytest.mark.parametrize("ids", [[*range(300), 10**15], [7 * 10**12 + i for i in range(300)] + [-(10**18), None], [5] * 301])
def test_uneven_ids_are_spread_by_text_size(spark, monkeypatch, ids):
    """No task gets much more than a bucket of text, and the order stays right across buckets."""
    monkeypatch.setattr(fp, "BUCKET_CHARS", 3000)
    rows = [(i, f"{k} " * 40) for k, i in enumerate(ids)]
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        got = fp.edited_pairs(frame(spark, rows)).select("doc_id", "text", "edited", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set(coalesce, old)
    load = {}
    for r in got:
        load[r["task"]] = load.get(r["task"], 0) + len(r["text"]) + 100
    assert len(load) > 1 and max(load.values()) <= 0.5 * sum(load.values())
    assert sorted(r["text"] for r in got) == sorted(t for _, t in rows)
    if len(set(ids)) == len(ids):
        order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
        edited = {r["doc_id"]: r["edited"] for r in got}
        for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
            k = len(t) // 3
            assert edited[i] == t[: len(t) - k] + after[:k]


def test_number_of_buckets_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET_CHARS", 100)
    monkeypatch.setattr(fp, "MOST_BUCKETS", 5)
    rows = [(i, f"{i} " * (20 + i % 7)) for i in range(200)]
    keyed = frame(spark, rows).select(F.lit(True).alias("_has"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key"), F.col("text").alias("_text"))
    assert 3 <= len(fp.bucket_starts(keyed)) <= 6
    got = {r["doc_id"]: r["edited"] for r in fp.edited_pairs(frame(spark, rows)).select("doc_id", "edited").collect()}
    for (i, t), (_, after) in zip(rows[::-1], rows[-2::-1] + rows[-1:], strict=True):
        k = len(t) // 3
        assert got[i] == t[: len(t) - k] + after[:k]


def test_empty_table(spark):
    assert fp.document_fingerprints(frame(spark, [])).collect() == []


def test_fraction_merge_and_containment(spark):
    a, b = [f"a{i}" for i in range(2000)], [f"b{i}" for i in range(400)]
    df = spark.createDataFrame([(" ".join(a), " ".join(a + b), " ".join(b))], "a string, ab string, b string")
    s = df.select(*[fp.sketch(F.col(c)).alias(c) for c in df.columns])
    r = s.select(
        F.size("a").alias("n"),
        fp.containment(F.col("b"), F.col("ab")).alias("inside"),
        fp.likeness(F.col("a"), F.col("b")).alias("apart"),
        fp.containment(fp.merged(F.col("a"), F.col("b")), F.col("ab")).alias("union"),
    ).first()
    assert abs(r["n"] / 1996 - 1 / fp.ONE_IN) < 0.05
    assert r["inside"] == 1.0 and r["apart"] == 0.0 and r["union"] == 1.0


@pytest.mark.parametrize("text,empty", [("one", False), ("", True), ("one two three", False)])
def test_short_texts_keep_a_stand_in(spark, text, empty):
    s = spark.createDataFrame([(text,)], "t string").select(fp.sketch(F.col("t")).alias("s")).first()["s"]
    assert (s == []) == empty
    assert len(s) <= 1
