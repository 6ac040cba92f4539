"""Parity-sketch join against all pairs of sets."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from corpus_ledger.llm import buffers, components, jaccard
from tests.llm.common import frame


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {k: k for k in range(len(sets))}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            (i, s), (j, t) = sets[a], sets[b]
            if i is not None and j is not None and s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(s), least.get(find(k)) if s and i is not None else i) for k, (i, s) in enumerate(sets)), key=repr)


def cases(seed):
    rnd = random.Random(seed)
    words = [f"v{k}" for k in range(400)]
    passage = rnd.choices(words, k=30)
    docs = []
    for _ in range(14):
        base = rnd.choices(words, k=rnd.choice([1, 3, 5, 6, 7, 9, 20, 60, 66, 150, 300]))
        if rnd.random() < 0.4:
            base = base + passage
        docs.append(" ".join(base))
        for _ in range(rnd.randrange(5)):  # chains of edits drift away from the first text
            k, much = rnd.randrange(len(base) or 1), rnd.choice([1, 1, 2, len(base) // 9 + 1])
            base = base[:k] + rnd.choices(words, k=rnd.choice([0, 1, much])) + base[k + rnd.choice([0, 1, much]) :]
            docs.append(" ".join(base))
    docs += [None, "", " \t\n", "Word", "word", "WORD x", docs[3], docs[3].upper()]
    ids = list(range(100, 100 + len(docs)))
    rnd.shuffle(ids)
    rows = list(zip(ids, docs, strict=True))
    return [*rows, (rows[0][0], rows[0][1]), (None, rows[5][1])]


@pytest.mark.parametrize("seed", (0, 3))
def test_against_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "MANY", 4 if seed else 0)  # 0: try other pivots whatever is open
    rows = cases(seed)
    got = jaccard.near_duplicates(frame(spark, rows, clash="key").repartition(3)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == brute(rows)


def test_heavy_buckets_lose_no_link(spark, monkeypatch):
    """Near copies of one text at every distance around the limit, with links among them that the text is no part of."""
    monkeypatch.setattr(jaccard, "MANY", 0)
    monkeypatch.setattr(jaccard, "PIVOT_ROUNDS", 0)  # nothing but the first pivots and the join by rare shingles
    rnd = random.Random(12)
    base = [f"b{k}" for k in range(160)]
    rows = [(0, " ".join(base))]
    for copy in range(70):
        words = list(base)
        for _ in range(rnd.randrange(0, 14)):
            words[rnd.randrange(len(words))] = f"c{copy}x{rnd.randrange(10**6)}"
        rows.append((len(rows), " ".join(words)))
        if copy % 3 == 0:  # a near copy of the near copy, longer or shorter
            again = words + [f"d{copy}"] * rnd.randrange(0, 25) if copy % 2 else words[: rnd.randrange(110, 160)]
            rows.append((len(rows), " ".join(again)))
    got = jaccard.near_duplicates(frame(spark, rows, clash="key").repartition(3)).collect()
    want = brute(rows)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == want
    assert 5 < len({c for _, _, c in want}) < 60


def test_prefixes_meet_at_the_limit():
    """Any two sets that link share a shingle of their prefixes that passes the test on what is left, whatever the order."""
    rnd = np.random.default_rng(6)
    for n in [1, 2, 3, 4, 5, 7, 8, 20, 63, 200]:
        for _ in range(200):
            m = int(rnd.integers(n, 4 * n // 3 + 1))
            shared = -(-3 * (n + m) // 7)
            if shared > n:
                continue
            pool = rnd.permutation(n + m)
            a, b = sorted(pool[:n]), sorted(np.concatenate([pool[:shared], pool[n : n + m - shared]]))
            found = False
            for x in set(a[: n // 4 + 1]) & set(b[: m // 4 + 1]):
                found |= 7 * min(n - a.index(x), m - b.index(x)) >= 3 * (n + m)
            assert found


def test_prefixes_become_rows_only_where_others_meet_them(spark, monkeypatch):
    """Of sets with shingles of their own, only what two components share becomes rows, each entry that can be half of a pair."""
    monkeypatch.setattr(jaccard, "HELD", 40)
    rnd = random.Random(4)
    common = [f"c{k}" for k in range(30)]
    texts = [" ".join([f"w{d}x{k}" for k in range(60)]) for d in range(20)]
    texts += [" ".join([*common, *[f"w{d}x{k}" for k in range(rnd.randrange(4))]]) for d in range(20, 30)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    hashes = {d: jaccard.shingle_sets(*[np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])])[0] for d, t in enumerate(texts)}
    keys = {d: int(buffers.signed(jaccard.class_keys(h, np.array([len(h)])))[0]) for d, h in hashes.items()}
    part = {keys[d]: d // 2 for d in keys}
    classes = spark.createDataFrame([(keys[d], d) for d in keys], "key bigint, least bigint").dropDuplicates(["key"])
    open_sets = spark.createDataFrame(list(part.items()), "key bigint, part bigint")
    none = spark.sparkContext.broadcast((np.zeros(0, np.int64), np.zeros(0, np.int64)))
    got = {tuple(r) for r in jaccard._rare_prefixes(open_sets, rows, classes, none).select("shingle", "key", "part", "n", "place").collect()}
    entries = {}
    for d, h in hashes.items():
        for place, shingle in enumerate(sorted(buffers.signed(h).tolist())[: len(h) // 4 + 1]):
            entries[shingle, keys[d]] = (shingle, keys[d], part[keys[d]], len(h), place)
    able = lambda x, y: x[0] == y[0] and x[2] != y[2] and (7 * x[4] <= x[3] or 7 * y[4] <= y[3])
    halves = {x for x in entries.values() if any(able(x, y) for y in entries.values())}
    assert halves <= got < set(entries.values())
    assert 0 < len(halves) and not [x for x in got if x[1] in {keys[d] for d in range(20)}]
    assert {x for x in got if 7 * x[4] <= x[3]} == {x for x in halves if 7 * x[4] <= x[3]}


def test_meeting_keeps_all_halves_of_pairs():
    rnd = np.random.default_rng(8)
    for _ in range(30):
        shingle, part, n = rnd.integers(0, 25, 80), rnd.integers(-3, 3, 80), rnd.integers(1, 60, 80)
        place = rnd.integers(0, n // 4 + 1)
        want = [any(shingle[i] == shingle[j] and part[i] != part[j] and (7 * place[i] <= n[i] or 7 * place[j] <= n[j]) for j in range(80)) for i in range(80)]
        kept = jaccard.meeting(shingle, part, n, place)
        assert (kept | ~np.array(want)).all()
        front = 7 * place <= n
        assert (kept[~front] == np.array(want)[~front]).all()


def tables_left(spark, job):
    """Tables below the checkpoint folder that a job leaves behind."""
    from corpus_ledger.session import ensure_checkpoint_dir

    there = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(there.iterdir())
    found = job()
    left = sorted(x.name.split("-")[0] for x in set(there.iterdir()) - before)
    return found, left


def test_tables_of_finished_steps_are_deleted(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MANY", 0)
    docs = frame(spark, cases(1), clash="key")
    found, left = tables_left(spark, lambda: jaccard.near_duplicates(docs))
    assert left == ["classes", "parts"] and found.count() == docs.count()
    found, left = tables_left(spark, lambda: jaccard.one_of_each(docs))
    assert left == ["placed"] and found.count() > 0


def test_empty_table(spark):
    assert jaccard.near_duplicates(frame(spark, [], clash="key")).collect() == []


def test_no_pair_is_lost_at_the_limit():
    """Sets that differ in as many shingles as allowed share a kept block, for every order of size."""
    rnd = np.random.default_rng(3)
    grade = np.zeros(jaccard.CELLS, np.uint8)
    for n in [3, 4, 5, 8, 15, 16, 20, 63, 64, 84, 200, 341, 1000, 5000]:
        for _ in range(20):
            m = int(rnd.integers(n, 4 * n // 3 + 1))
            most = (n + m) // 7
            only_a = (most - (m - n)) // 2
            if only_a < 0:
                continue
            pool = rnd.integers(0, 1 << 63, n + m, dtype=np.int64).view(np.uint64)
            a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[only_a:n], pool[n : n + m - (n - only_a)]]))
            grade[rnd.integers(0, jaccard.CELLS, 1 << 20)] = rnd.integers(0, 32)
            own, sign, poor = jaccard.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), grade, 0)
            assert not len(poor)
            assert set(sign[own == 0].tolist()) & set(sign[own == 1].tolist()) or len(np.setxor1d(a, b)) == 0


@pytest.mark.parametrize("batch", [1, 2, 3, 100])
def test_buckets_do_not_depend_on_batches(batch):
    rnd = random.Random(batch)
    rows = sorted((rnd.randrange(12), rnd.choice([6, 7, 8, 9, 12, 16, 40]), rnd.randrange(9)) for _ in range(90))
    parts = [rows[k : k + batch] for k in range(0, len(rows), batch)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in p]), pa.array([r[2] for r in p]), pa.array([r[1] for r in p])], names=["sign", "key", "n"]) for p in parts]
    got = [tuple(r.values()) for b in jaccard._buckets(iter(batches)) for r in b.to_pylist()]
    want = []
    for s in range(12):
        members, pivot = sorted({r[1:] for r in rows if r[0] == s}), None
        for n, k in members:
            if pivot is None or 3 * n > 4 * pivot[0]:
                pivot = (n, k)
            if len(members) > 1:
                want.append((s, k, n, pivot[1]))
    assert sorted(got) == sorted(want)


def test_components_of_paths_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 100), (7, 7), (200, 200)]
    got = dict(components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**{k: 0 for k in range(41)}, 90: 90, 100: 90, 200: 200}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_ties_to_the_smallest_need_no_round(spark, monkeypatch):
    monkeypatch.setattr(components, "_large_star", None)
    edges = [(1, k) for k in range(2, 30)] + [(30, k) for k in range(31, 40)] + [(1, 2), (5, 1)]
    got = dict(components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**{k: 1 for k in range(1, 30)}, **{k: 30 for k in range(30, 40)}}


def test_components_of_random_graphs(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(230)]
    root = {k: k for e in edges for k in e}
    for _ in range(300):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert len(got) == len(root) and dict(got) == root


def test_parity_bits_bound_the_difference():
    a = np.arange(1, 90, dtype=np.uint64) * np.uint64(buffers.BASE)
    b = np.concatenate([a[5:], a[:3] + np.uint64(17)])
    x, y = jaccard.parity_bits(a), jaccard.parity_bits(b)
    assert len(x) == len(y) and sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= 8
