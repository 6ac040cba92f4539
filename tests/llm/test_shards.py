"""Minimax cuts against search over all capacities."""

import random
import zlib
from collections import defaultdict

import pytest

from corpus_ledger.llm import shards
from tests.llm.common import frame


def greedy(sizes, capacity):
    """Ends of shards as counts of groups."""
    out, load = [], capacity + 1
    for k, s in enumerate(sizes):
        if load + s > capacity:
            out.append(k)
            load = 0
        load += s
    return [*out[1:], len(sizes)] if sizes else []


def best(sizes, n):
    c = max(max(sizes), -(-sum(sizes) // n))
    while len(greedy(sizes, c)) > n:
        c += 1
    return c


@pytest.mark.parametrize("seed,fences", [(0, 20_000), (1, 7), (2, 30)])
def test_cuts_are_smallest(spark, seed, fences):
    rnd = random.Random(seed)
    sizes = [rnd.randrange(1, 60) for _ in range(rnd.choice([150, 401]))]
    if seed == 1:
        sizes[70] = 2000
    rows = [(s, k + 1) for k, s in enumerate(sizes)]
    rnd.shuffle(rows)
    n = 9
    capacity, cuts = shards.minimax_cuts(spark.createDataFrame(rows, "size bigint, last bigint").repartition(3), n, fences)
    assert capacity == best(sizes, n)
    want = greedy(sizes, capacity)
    assert [last for _, last in cuts] == want + [len(sizes)] * (n - len(want))


def loads_of(spark, sizes, n, fences):
    rows = [(s, k + 1) for k, s in enumerate(sizes)]
    random.Random(0).shuffle(rows)
    capacity, cuts = shards.level_cuts(spark.createDataFrame(rows, "size bigint, last bigint").repartition(3), n, fences)
    ends = [0, *[last for _, last in cuts]]
    loads = [sum(sizes[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
    assert len(cuts) == n and ends[-1] == len(sizes) and ends == sorted(ends)
    assert [upto for upto, _ in cuts] == [sum(sizes[:e]) for e in ends[1:]]
    assert capacity == best(sizes, n) and max(loads) == capacity
    return loads


@pytest.mark.parametrize("fences", [20_000, 11])
def test_a_large_group_leaves_no_shard_empty(spark, fences):
    sizes = [random.Random(5).randrange(1, 60) for _ in range(400)]
    sizes[150] = sum(sizes) // 2  # a third of all bytes
    loads = loads_of(spark, sizes, 12, fences)
    rest = sorted(loads)[:-1]
    assert min(loads) > 0 and rest[-1] <= 1.3 * sum(rest) / 11 and rest[1] >= 0.7 * sum(rest) / 11


@pytest.mark.parametrize("seed", range(4))
def test_level_cuts_keep_the_minimax(spark, seed):
    rnd = random.Random(seed)
    sizes = [rnd.choice([1, 3, 40, 700 if seed % 2 else 50]) for _ in range(rnd.randrange(7, 60))]
    assert min(loads_of(spark, sizes, 7, 5 if seed < 2 else 20_000)) > 0


def test_fewer_groups_than_shards(spark):
    assert loads_of(spark, [5, 900, 5], 5, 20_000) == [5, 900, 5, 0, 0]


def test_large_group_of_documents(spark):
    """Copies of one text take a shard; the other texts fill all others."""
    rows = [(k, "x" * 200 + str(k)) for k in range(400)] + [(1000 + k, "copy " * 40) for k in range(200)]
    loads = defaultdict(int)
    for r in shards.sharded(frame(spark, rows, "size")).collect():
        loads[r["shard"]] += r["size"]
    rest = sorted(loads.values())[:-1]
    assert sorted(loads) == list(range(shards.SHARDS)) and rest[-1] <= 1.3 * sum(rest) / len(rest)


def test_documents(spark):
    rnd = random.Random(3)
    rows = [(k, "z" * rnd.randrange(1, 300) + str(k % 150)) for k in range(200)]
    rows += [(500 + k, "copy of one text " * 20) for k in range(100)] + [(900, None), (901, ""), (None, "é" * 50), (7, rows[7][1])]
    got = shards.shard(frame(spark, rows, "size").repartition(4), shards=6).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    places, of = defaultdict(list), defaultdict(set)
    for r in got:
        body = (text[r["doc_id"]] or "").encode()
        assert r["size"] == len(body) + 8 and r["text_crc32"] == zlib.crc32(body)
        places[r["shard"]].append(r["slot"])
        of[text[r["doc_id"]]].add(r["shard"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert all(len(s) == 1 for s in of.values())
    load = defaultdict(int)
    for r in got:
        load[r["shard"]] += r["size"]
    assert max(load.values()) <= sum(load.values()) / 6 + 100 * 348


def test_empty_and_single(spark):
    assert shards.shard(frame(spark, [], "size")).collect() == []
    assert [tuple(r) for r in shards.sharded(frame(spark, [(5, "ab")], "size")).collect()] == [(5, 10, zlib.crc32(b"ab"), "bytes", 0, 0, None)]
