"""Periodic runs against brute force: Lyndon words by comparing suffixes, runs by comparing words."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpus_ledger.llm import queries, runs


def plain_lyndon(text):
    ends = []
    for i in range(len(text)):
        j = i + 1
        while j < len(text) and text[j:] > text[i:]:
            j += 1
        ends.append(j - i)
    return ends


def plain_runs(words, least_periods=4, least_length=6):
    """Every maximal stretch with period p, for each p, smallest periods only."""
    n, found = len(words), {}
    for p in range(1, n // least_periods + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            length = i - start + p
            if i > start and length >= max(least_periods * p, least_length):
                found.setdefault((start, length), p)
            i += i == start
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


texts = st.lists(st.integers(0, 3), max_size=50)


@settings(max_examples=200, deadline=None)
@given(texts)
def test_lyndon_lengths(text):
    assert runs.lyndon_lengths(text) == plain_lyndon(text)
    upside = [-s for s in text]
    assert runs.lyndon_lengths(upside) == plain_lyndon(upside)


@settings(max_examples=200, deadline=None)
@given(texts, texts, st.integers(1, 12), st.sampled_from([(2, 2), (3, 3), (4, 6)]))
def test_runs_of_words(before, root, times, least):
    words = [str(s) for s in before + root[:9] * times + before[::-1]]
    assert runs.word_runs(words, *least) == plain_runs(words, *least)


def test_wrong_hashes_are_found_out(monkeypatch):
    """Even if every two stretches hash alike, the words decide."""
    monkeypatch.setattr(runs.Stretches, "same", lambda self, a, b, length: a == a)
    words = "x y a b a b a b a b z q q q q q q".split()
    assert runs.word_runs(words) == plain_runs(words) == [(2, 8, 2), (11, 6, 1)]


def test_long_period_and_long_run():
    rnd = random.Random(4)
    root = [str(rnd.randrange(50)) for _ in range(700)]
    assert runs.word_runs(["start"] + root * 40 + root[:9] + ["end"]) == [(1, 28009, 700)]
    assert runs.word_runs(["a"] * 100_000) == [(0, 100_000, 1)]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
        sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def as_rows(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_query_over_whole_table(spark, tmp_path):
    rnd = random.Random(9)
    rows = []
    for doc_id in range(400):
        words = [rnd.choice("aa bb cc ñandú dd ee".split()) for _ in range(rnd.randrange(60))]
        if doc_id % 3 == 0:
            words[5:5] = rnd.sample(words, min(len(words), rnd.randrange(1, 5))) * rnd.randrange(3, 9)
        rows.append((doc_id, rnd.choice([" ", "\t", "\n", "  "]).join(words), "clash", 1))
    rows += [(400, None, None, None), (401, "", "x", 2), (402, " \n ", "x", 2), (403, "z " * 20_000, "x", 3), (403, "z " * 20_000, "x", 3)]
    rows += [(404, " a  b", "x", 4), (405, "one", "x", 5)]
    spark.createDataFrame(rows, "doc_id long, text string, runs string, id int").write.parquet(f"{tmp_path}/documents.parquet")
    got = as_rows(queries.op12_periodic_runs(spark, str(tmp_path)))
    assert got == sorted(expected(r[0], r[1]) for r in rows)
    assert sum(r[1] > 0 for r in got) > 40


def test_null_ids_and_no_rows(spark):
    none = runs.document_runs(spark.createDataFrame([], "doc_id long, text string"))
    assert none.collect() == [] and none.columns == ["doc_id", "runs", "collapsed"]
    rows = spark.createDataFrame([(None, "a a a a a a b"), (None, None)], "doc_id long, text string")
    got = sorted((len(r["runs"]), r["collapsed"]) for r in runs.document_runs(rows).collect())
    assert got == [(0, ""), (1, "a b")]


@pytest.mark.parametrize("n", [0, 1, 7, 50])
def test_edit_of_the_contract(n):
    words = [str(i).encode() for i in range(n)]
    for doc_id in range(200):
        assert len(queries.repeated_tail(doc_id, words)) == n
    assert queries.repeated_tail(None, words) == words
