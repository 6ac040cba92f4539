"""Fingerprints, toxicity and language ID against the same sums in plain Python."""

import math
import random
import zlib

import numpy as np
import pytest

from corpus_ledger.llm import chargrams, langid, queries, toxicity
from corpus_ledger.llm import fingerprints as fp

xxhash = pytest.importorskip("xxhash")


# -- fingerprints: hashes, edits and likeness from sets of words ------------------------------


def plain_sketch(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    grams = [words[i : i + 5] for i in range(max(1, len(words) - 4))] if words else []
    hashes = set()
    for gram in grams:
        h = 42
        for w in gram:
            h = xxhash.xxh64_intdigest(w.encode(), seed=h)
        hashes.add(h - (1 << 64) if h >= 1 << 63 else h)
    low = {h for h in hashes if h < -(1 << 63) + (1 << 62)}
    return low or set(sorted(hashes)[:1])


def plain_likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_against_sets(spark, tmp_path):
    rnd = random.Random(3)
    vocabulary = [f"Wörd{k}" for k in range(40)]
    rows = [(k * 7, " ".join(rnd.choices(vocabulary, k=rnd.randrange(0, 120)))) for k in range(60)]
    rows += [(1000, None), (1001, ""), (1002, "a b"), (1003, "A B"), (1004, rows[5][1] + " more"), (1005, rows[5][1])]
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, sketch string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op1_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        cut = len(text) // 3
        own, edited, following = (plain_sketch(t) for t in (text, text[: len(text) - cut] + after[:cut], after))
        signed = [int(got[i]["fingerprint"][k : k + 16], 16) for k in range(0, len(got[i]["fingerprint"]), 16)]
        assert [h - (1 << 64) if h >= 1 << 63 else h for h in signed] == sorted(own)
        assert got[i]["near_edited"] == pytest.approx(plain_likeness(own, edited))
        assert got[i]["near_next"] == pytest.approx(plain_likeness(own, following))


# -- toxicity: ratios by counting, the fit by its optimum, scores by sets ---------------------


def cells(text):
    """Distinct cells of a text, n-gram by n-gram."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = set()
    for size in toxicity.SIZES:
        for k in range(len(low) - size + 1):
            points = np.array([ord(c) for c in low[k : k + size]], np.uint32)
            found.add(int(chargrams.gram_cells(points, size, toxicity.CELLS)[0]))
    return found


@pytest.fixture(scope="module")
def labelled():
    rnd = random.Random(8)
    words = [f"plain{k}" for k in range(60)]
    rows = []
    for k in range(160):
        text = " ".join(rnd.choices(words, k=rnd.randrange(3, 25)) + (rnd.choices(["vile", "Rotten", "slur"], k=2) if k % 3 == 0 else []))
        rows.append((k, text, int(k % 3 == 0)))
    return rows


def test_toxicity_against_counting(spark, labelled):
    docs = spark.createDataFrame([(k, t) for k, t, _ in labelled], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, y) for k, _, y in labelled], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    train = [(cells(t), y) for k, t, y in labelled if zlib.crc32(str(k).encode()) % 5]
    n = [sum(y == c for _, y in train) for c in (0, 1)]
    seen = {}
    for own, y in train:
        for c in own:
            seen.setdefault(c, [0, 0])[y] += 1
    ratio = {c: math.log((t + 1) / (n[1] + 2) / ((q + 1) / (n[0] + 2))) for c, (q, t) in seen.items()}
    chosen = {c for c, (q, t) in seen.items() if t >= 3 and ratio[c] > 0}
    assert set(model.cells.tolist()) == chosen and len(chosen) <= toxicity.FEATURES
    # At the optimum the slope of the regularised loss over scaled features vanishes.
    coefficient = {c: w / ratio[c] for c, w in zip(model.cells.tolist(), model.weights.tolist())}
    weight = dict(zip(model.cells.tolist(), model.weights.tolist()))
    slope, flat = dict.fromkeys(chosen, 0.0), 0.0
    for own, y in train:
        z = sum(weight[c] for c in own & chosen) + model.intercept
        share = toxicity.TOXIC_WEIGHT / n[1] if y else (1 - toxicity.TOXIC_WEIGHT) / n[0]
        off = share * (1 / (1 + math.exp(-z)) - y)
        flat += off
        for c in own & chosen:
            slope[c] += off * ratio[c]
    assert abs(flat) < 1e-3
    assert max(abs(s + toxicity.RIDGE * coefficient[c]) for c, s in slope.items()) < 1e-3
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, model).collect()}
    for k, text, _ in labelled:
        z = sum(weight[c] for c in cells(text) & chosen) + model.intercept
        assert got[k] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


# -- language ID: frequencies, vectors, centres and cosines ------------------------------------


def gram_counts(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    counts = np.zeros(langid.CELLS)
    for size in langid.SIZES:
        for k in range(len(low) - size + 1):
            points = np.array([ord(c) for c in low[k : k + size]], np.uint32)
            counts[int(chargrams.gram_cells(points, size, langid.CELLS)[0])] += 1
    return counts


def test_language_id_against_plain_vectors(spark):
    rnd = random.Random(4)
    alphabets = {"xx": "abcde", "yy": "defgh", "zz": "éöüñß"}
    rows = [(k, "".join(rnd.choices(alphabets[lang] + " ", k=rnd.randrange(5, 60))), lang) for k, lang in enumerate(rnd.choices([*alphabets], k=150))]
    rows += [(500, None, "xx"), (501, "123 !", "yy"), (502, "abc", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    train = [(gram_counts(t), lang) for k, t, lang in rows if t is not None and lang is not None and zlib.crc32(str(k).encode()) % 4 != 2]
    frequency = sum((c > 0).astype(int) for c, _ in train)
    idf = np.log((1 + len(train)) / (1 + frequency)) + 0.1
    assert np.allclose(model.idf, idf, atol=1e-5)

    def vector(counts):
        v = np.log1p(counts) * idf
        return v / max(np.linalg.norm(v), 1e-12)

    # Each centre is the direction of the training vectors that are nearest to it among those of its language.
    assert sorted(set(model.languages)) == ["xx", "yy", "zz"]
    for lang in alphabets:
        own = [k for k, name in enumerate(model.languages) if name == lang]
        points = np.array([vector(c) for c, name in train if name == lang])
        nearest = (points @ model.centres[own].T).argmax(1)
        for j, k in enumerate(own):
            mean = points[nearest == j].sum(0)
            assert model.centres[k] @ mean / np.linalg.norm(mean) > 0.98
    for r in langid.identified(docs, model).collect():
        text = next(t for k, t, _ in rows if k == r["doc_id"])
        if not any(c.isalpha() for c in text or ""):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
            continue
        cosine = model.centres.astype(float) @ vector(gram_counts(text))
        best = cosine.max()
        assert r["score"] == pytest.approx(min(max(best, 0), 1), abs=1e-4)
        near = {model.languages[k] for k in np.flatnonzero(cosine > best - 1e-4)}
        assert r["lang_pred"] in near
        limits = [model.limits[k] for k in np.flatnonzero(cosine > best - 1e-4)]
        assert r["rejected"] in {best < x + 1e-4 for x in limits} | {best < x - 1e-4 for x in limits}
