"""Window dedup of words and bytes against counts of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from corpus_ledger.llm import expansion, repeats, windows
from tests.llm.common import frame


def brute(rows, width, words):
    items = [((t or "").split() if words else list((t or "").encode())) for _, t in rows]
    count = Counter(tuple(x[k : k + width]) for x in items for k in range(len(x) - width + 1))
    out = []
    for (i, _), x in zip(rows, items, strict=True):
        gone = set()
        for k in range(len(x) - width + 1):
            if count[tuple(x[k : k + width])] > 1:
                gone |= set(range(k, k + width))
        kept = [v for k, v in enumerate(x) if k not in gone]
        body = " ".join(kept).encode() if words else bytes(kept)
        spans = sum(1 for k in gone if k - 1 not in gone)
        out.append((i, len(x), len(gone), spans, hashlib.sha256(body).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_items"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()), key=repr)


def texts(seed, unit, sep):
    rnd = random.Random(seed)

    def some(n):
        return [unit(rnd) for _ in range(n)]

    passage, long = some(36), some(120)
    docs = [some(rnd.randrange(0, 200)) for _ in range(8)]
    docs += [some(rnd.randrange(9)) + passage + some(rnd.randrange(40)) for _ in range(12)]
    docs += [long, list(long), long[:60] + some(1) + long[61:], long[3:90], some(5) + long[40:] + some(4), long[:35], long[:34]]
    docs += [["x"] * 90, ["x", "y"] * 60, ["x"] * 35, ["x"] * 34, long + some(3) + long]
    ids = list(range(len(docs)))
    rnd.shuffle(ids)
    rows = [(i, sep.join(d)) for i, d in zip(ids, docs, strict=True)]
    return [*rows, (900, None), (901, ""), (902, "  \n"), rows[20], (None, rows[21][1])]


@pytest.mark.parametrize("seed", range(2))
def test_words_against_counts(spark, seed):
    rows = texts(seed, lambda r: f"é{r.randrange(5000)}", " ")
    got = windows.repeated_words(frame(spark, rows, "row").repartition(3))
    assert result(got) == brute(rows, 35, True)


@pytest.mark.parametrize("seed,crowd", [(0, 4000), (1, 3)])
def test_bytes_against_counts(spark, seed, crowd, monkeypatch):
    monkeypatch.setattr(expansion, "CROWD", crowd)
    rows = texts(seed, lambda r: f"w{r.randrange(10**10):010}é", " ")
    got = expansion.repeated_bytes(frame(spark, rows, "row").repartition(3), whole=True).cache()
    assert result(got) == brute(rows, 400, False)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got.collect())


def test_empty_tables(spark):
    assert windows.repeated_words(frame(spark, [], "row")).collect() == []
    assert expansion.repeated_bytes(frame(spark, [], "row")).collect() == []


@pytest.mark.parametrize("width", [1, 3, 8, 9, 40])
def test_classes_are_equal_windows(width):
    rnd = np.random.default_rng(width)
    parts = [rnd.integers(65, 68, n).astype(np.uint8) for n in (300, 50, 9, 200, 45)]
    parts += [parts[0][20:170], np.full(60, 65, np.uint8)]
    data, offsets = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    classes = expansion.equal_windows(data, offsets, width)
    seen = {}
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        for k in range(a, b - width + 1):
            w = data[k : k + width].tobytes()
            assert seen.setdefault(("w", w), classes[k]) == classes[k]
            assert seen.setdefault(("c", classes[k]), w) == w


def test_runs_tile_all_windows():
    rnd = np.random.default_rng(0)
    codes = rnd.integers(0, 3, 4000).astype(np.uint64) * np.uint64(repeats.buffers.BASE)
    at = np.array([0, 0, 700, 705, 3000, 4000])
    runs = repeats.Runs(codes, at, 20, 6)
    covered = np.repeat(runs.start, runs.length) + repeats.buffers.places(runs.length)
    want = [k for a, b in zip(at[:-1], at[1:], strict=True) for k in range(a, b - 19)]
    assert covered.tolist() == want
    assert runs.length.max() <= 15


def test_filter_forgets_nothing(spark):
    keys = np.random.default_rng(4).integers(0, 1 << 62, 5000).astype(np.uint64)
    found = repeats.Filter(20, [np.bincount(c, minlength=1 << 20).astype(np.uint8) for c in repeats.cells_of(keys, 20)])
    found.rows = [np.packbits(r > 0, bitorder="little") for r in found.rows]
    assert found.repeated(keys).all()
    assert found.repeated(keys + np.uint64(1)).mean() < 0.01
