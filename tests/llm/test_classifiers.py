"""Held-out accuracy of the two classifiers, and their defined results for awkward rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_ledger.llm import buffers, chargrams, langid, toxicity
from tests.llm.common import frame

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_toxicity_on_held_out_rows(spark, docs, labels):
    got = toxicity.toxicity_report(docs, labels).join(labels, "doc_id").toPandas()
    for r in got.itertuples():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = got[got.held_out]
    assert (held.predicted == held.toxic).mean() >= 0.93
    order = held.score.rank()
    n1, n0 = (held.toxic == 1).sum(), (held.toxic == 0).sum()
    assert (order[held.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) >= 0.85  # area under the curve


def test_labels_of_held_out_rows_are_not_used(spark, docs, labels):
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, turned)
    assert (a.cells == b.cells).all() and np.allclose(a.weights, b.weights) and a.intercept == pytest.approx(b.intercept)


def test_toxicity_of_awkward_rows(spark, docs, labels):
    model = toxicity.fit(docs, labels)
    rows = [(1, None), (2, ""), (3, "ab"), (4, "x" * 300_000), (None, "you moron scum idiot trash"), (5, "é"), (5, "é")]
    got = toxicity.scored(frame(spark, rows, "score"), model).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[1] == by[2] == by[3] < 0.5
    assert toxicity.scored(frame(spark, [], "score"), model).collect() == []
    kept = toxicity.keep_clean(frame(spark, rows, "score"), model).collect()
    assert {tuple(r) for r in kept} <= {(i, t, "clash") for i, t in rows} and len(kept) >= 5


def test_labels_of_absent_documents_take_no_place(spark, docs, labels, monkeypatch):
    monkeypatch.setattr(toxicity, "training_ids", lambda by_id, most=20, pick=toxicity.training_ids: pick(by_id, most))
    others = spark.range(10**9, 10**9 + 4000).select(F.col("id").alias("doc_id"), F.lit(0).alias("quality"), (F.col("id") % 2).cast("int").alias("toxic"))
    want, got = toxicity.fit(docs, labels), toxicity.fit(docs, labels.select("doc_id", "quality", "toxic").unionByName(others))
    assert len(got.cells) and (got.cells == want.cells).all() and np.allclose(got.weights, want.weights)


def test_toxicity_without_labels(spark, docs, labels):
    none = labels.limit(0)
    assert all(r["score"] < 1e-100 for r in toxicity.toxicity_report(docs.limit(5), none).collect())
    odd = spark.createDataFrame([(1, 0, None), (None, 1, 1), (3, 0, 7)], "doc_id bigint, quality int, toxic int")
    assert toxicity.toxicity_report(docs.limit(5), odd).filter("predicted = 1").count() == 0


def test_language_on_held_out_rows(spark, docs):
    got = langid.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    for r in got.itertuples():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.lang_pred in {"en", "de", "fr", "es", "und"}
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() >= 0.93
    assert got.rejected.mean() < 0.05


def test_language_of_awkward_rows(spark, docs):
    model = langid.fit(docs)
    rows = [(1, None), (2, ""), (3, "12 34 ..!"), (4, "der die und nicht " * 20000), (5, "日本語"), (None, "the of and"), (6, "é"), (6, "é"), (7, "١٢٣")]
    got = langid.identified(frame(spark, rows, "lang"), model).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: (r["lang_pred"], r["score"], r["rejected"]) for r in got}
    assert by[1] == by[2] == by[3] == by[7] == ("und", 0.0, True)
    assert by[4][0] == "de" and by[5][0] != "und" and by[5][2]
    assert langid.identified(frame(spark, [], "lang"), model).collect() == []


def test_language_with_nothing_to_learn(spark):
    rows = spark.createDataFrame([(k, "some text", None) for k in range(8)], "doc_id bigint, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in langid.language_report(rows).collect()} == {("und", 0.0)}


def test_grams_stay_within_texts():
    data, offsets = np.frombuffer("ABéd".encode() + b"xyz", np.uint8), np.array([0, 5, 5, 8])
    points, at = chargrams.code_points(data, offsets)
    assert at.tolist() == [0, 4, 4, 7] and points[0] == ord("a")
    text, cell = chargrams.grams(points, at, (3,), 1 << 20)
    assert text.tolist() == [0, 0, 2] and len(set(cell.tolist())) == 3
    broken = np.frombuffer(b"a\xffb", np.uint8)
    assert len(chargrams.code_points(broken, np.array([0, 3]))[0]) == 3
    assert buffers.places([2, 0, 1]).tolist() == [0, 1, 0]
