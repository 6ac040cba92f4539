"""Each stage of the pipeline against the same decision made in plain Python."""

import random

import pytest

from tests.llm.test_decontaminate import brute as brute_contamination
from tests.llm.test_jaccard import brute as brute_components

pipeline = pytest.importorskip("corpus_pipeline")

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus():
    rnd = random.Random(11)
    words = [f"w{k}é" for k in range(3000)]

    def some(n):
        return " ".join(rnd.choices(words, k=n))

    passage, item = some(120), some(40)
    texts = [some(rnd.randrange(20, 150)) for _ in range(60)]
    texts += [f"{some(9)} moron {some(9)} idiot scum" for _ in range(25)]
    texts += [some(200) + " " + passage + " " + some(200) for _ in range(3)]
    texts += [texts[0], texts[1] + " x", texts[2].replace("w", "w", 1), None, "", " \n", some(10) + " " + item, item, "Ü" * 500, "Ü" * 500 + some(300)]
    rows = [(k, t, "en", f"s{k}", len(t) if t else 0) for k, t in enumerate(texts)]
    rows += [rows[70][:1] + rows[3][1:], (None, None, None, None, None), (None, texts[4], "en", "s", 1), rows[5], (6, some(30), "en", "other", 3)]
    labels = [(k, 0, int(t is not None and "moron" in t)) for k, t in enumerate(texts) if k % 7] + [(2, 1, None), (None, 0, 1)]
    bench = [(1, item), (2, None), (3, "")]
    return rows, labels, bench


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("sf"))
    rows, labels, bench = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages(spark, folder):
    rows, _, bench = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    stage = dict(pipeline.STAGES)
    clean = listed(stage["toxicity"](spark, docs, folder))
    assert clean == sorted((r for r in rows if not (r[1] and "moron" in r[1])), key=repr)

    one = listed(stage["ngram_jaccard"](spark, spark.createDataFrame(clean, SCHEMA), folder))
    component = brute_components([(r[0], r[1]) for r in clean])
    linked = {c for i, n, c in component if n and i is not None}
    assert sorted(r[0] for r in one if r[0] is not None and (r[1] or "").split()) == sorted(linked)
    assert [r for r in one if r[0] is None or not (r[1] or "").split()] == [r for r in clean if r[0] is None or not (r[1] or "").split()]
    assert set(one) <= set(clean)

    cut = listed(stage["suffix_dedup"](spark, spark.createDataFrame(one, SCHEMA), folder))
    assert len(cut) == len(one)
    bodies = [(r[1] or "").encode() for r in one]
    windows = {}
    for b in bodies:
        for k in range(len(b) - 399):
            windows[b[k : k + 400]] = windows.get(b[k : k + 400], 0) + 1
    want = []
    for r, b in zip(one, bodies, strict=True):
        gone = {j for k in range(len(b) - 399) if windows[b[k : k + 400]] > 1 for j in range(k, k + 400)}
        text = None if r[1] is None else bytes(c for k, c in enumerate(b) if k not in gone).decode(errors="ignore")
        want.append((r[0], text, r[2], r[3], None if text is None else len(text)))
    assert cut == sorted(want, key=repr)
    assert any(len(a[1] or "") != len(b[1] or "") for a, b in zip(one, sorted(want, key=repr), strict=False))

    free = listed(stage["decontaminate"](spark, spark.createDataFrame(cut, SCHEMA), folder))
    bad = {k for k, r in enumerate(cut) if brute_contamination([(r[0], r[1])], bench)[0][-1]}
    assert bad and free == [r for k, r in enumerate(cut) if k not in bad]

    last = stage["sentencepiece"](spark, spark.createDataFrame(free, SCHEMA), folder).collect()
    assert len(last) == len(free) and all(r["exact"] for r in last)


def test_run_and_empty_tables(spark, folder, tmp_path):
    assert pipeline.run(spark, folder).filter("exact").count() > 50
    for name, schema in (("documents", SCHEMA), ("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []
