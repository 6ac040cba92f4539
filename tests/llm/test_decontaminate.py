"""FM-index search against plain scans."""

import hashlib
import random
import re

import numpy as np
import pytest

from corpus_ledger.llm import decontaminate as de
from corpus_ledger.llm.fm_index import FMIndex, suffix_order
from tests.llm.common import frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, bench):
    phrases = {}
    for i, t in bench:
        w = words(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            phrases.setdefault(tuple(w[k : k + 13]), set()).add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, items = words(t), set(), set()
        for p, its in phrases.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit |= set(range(k, k + len(p)))
                    items |= its
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def cases():
    rnd = random.Random(5)
    vocabulary = ["The", "a", "Über", "naïve", "x1", "of", "zeta", "q"]
    bench = [(k, " ".join(rnd.choices(vocabulary, k=n))) for k, n in enumerate((30, 13, 14, 12, 3, 1, 0, 20))] + [(None, "only null id here"), (99, None), (10, "a; b; c"), (3, "a; b; c")]
    docs = [(k, " ".join(rnd.choices(vocabulary, k=n))) for k, n in enumerate((400, 5, 0, 90, 13, 200))]
    docs += [(50, bench[0][1]), (51, "x " + bench[0][1].upper().replace("ÜBER", "Über").replace("NAÏVE", "naïve") + ".y"), (52, None), (53, "..."), (54, "a b c, a b c"), (54, "a b c, a b c")]
    docs += [(60, "pad " * 5000 + bench[7][1]), (None, bench[2][1])]
    return docs, bench


@pytest.mark.parametrize("most", [de.PASS_PHRASES, 9])
def test_against_scan(spark, most, monkeypatch):
    docs, bench = cases()
    monkeypatch.setattr(de, "PASS_PHRASES", most)
    b = spark.createDataFrame([(i, t, 0) for i, t in bench], "item_id bigint, text string, doc_id int")
    got = de.contamination(frame(spark, docs), b, most=most)
    got = got.select("doc_id", "n_words", "n_hit", "items", "spans", "text").collect()
    want = brute(docs, bench)
    mine = sorted(
        ((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(sorted(r["items"])).encode()).hexdigest(), r["n_hit"] > 0 and 20 * r["n_hit"] >= r["n_words"]) for r in got),
        key=repr,
    )
    assert mine == want
    for r in got:
        body = (r["text"] or "").encode()
        assert sum(len(words(body[s["start"] : s["end"]].decode())) for s in r["spans"]) == r["n_hit"]


def test_report_over_empty_tables(spark):
    docs, bench = cases()
    none = spark.createDataFrame([], "item_id bigint, text string")
    got = de.decontamination_report(frame(spark, docs), none).collect()
    assert len(got) == len(docs) and not any(r["contaminated"] for r in got)
    assert de.decontamination_report(frame(spark, []), none).collect() == []


def test_index_counts_and_places():
    rnd = np.random.default_rng(1)
    s = rnd.integers(1, 6, 500)
    order = suffix_order(s)
    assert [tuple(s[k:]) for k in order] == sorted(tuple(s[k:]) for k in range(len(s)))
    index = FMIndex(s, 7)
    phrases = np.array([s[a : a + 4] for a in range(0, 400, 7)] + [[5, 5, 5, 7]])
    own, low, high = index.search(phrases, np.full(len(phrases), 4))
    assert set(own) == set(range(len(phrases) - 1))
    for k, lo, hi in zip(own, low, high, strict=True):
        want = [a for a in range(len(s) - 3) if list(s[a : a + 4]) == list(phrases[k])]
        assert sorted(index.locate(np.arange(lo, hi))) == want
