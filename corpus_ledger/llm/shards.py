"""Sharding by contiguous partition of ordered atomic groups: the largest shard as small as any cut allows, the others near equal."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .tables import written

SHARDS = 24
OVERHEAD = 8
#: Group ends the driver holds at most; between them it knows bounds, and looks closer where that matters.
FENCES = 20_000


class Ends:
    """Some of the group ends (running sums of sizes) with their ranks, in order.

    Between ends of adjacent rank, and inside the ``complete`` ranges, no end is missing.
    """

    def __init__(self, ends: np.ndarray, ranks: np.ndarray, complete: list[tuple[int, int]]):
        self.ends, self.adjacent = ends, np.append(np.diff(ranks) == 1, True)
        self.from_, self.to = (np.array(x, np.int64) for x in zip(*complete, strict=True)) if complete else (np.zeros(0, np.int64),) * 2

    def reach(self, x: int, hopeful: bool) -> int:
        """The largest group end up to ``x``: a bound from below or, if ``hopeful``, from above."""
        k = int(np.searchsorted(self.ends, x, side="right")) - 1
        if not hopeful or self.adjacent[k]:
            return int(self.ends[k])
        j = int(np.searchsorted(self.from_, x, side="right")) - 1
        return int(self.ends[k]) if j >= 0 and x <= self.to[j] else x

    def cuts(self, capacity: int, shards: int, hopeful: bool = False) -> list[int]:
        """Greedy cuts: each shard takes all groups that fit."""
        at, out = 0, []
        for _ in range(shards):
            at = min(self.reach(at + capacity, hopeful), int(self.ends[-1]))
            out.append(at)
        return out

    def smallest(self, low: int, high: int, shards: int, hopeful: bool) -> int:
        """Binary search: the smallest capacity whose greedy cuts reach the end; ``high`` does."""
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, hopeful)[-1] >= self.ends[-1]:
                high = middle
            else:
                low = middle + 1
        return high


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running size and rank within the partition."""
    from pyspark import TaskContext

    part, size, rank = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sums = np.cumsum(np.asarray(batch.column(0))) + size
        ranks = np.arange(rank + 1, rank + 1 + batch.num_rows)
        size, rank = int(sums[-1]), int(ranks[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(batch.num_rows, part), pa.int32()), pa.array(sums), pa.array(ranks), *batch.columns], names=["part", "upto", "rank", "size", "last"]
        )


class Groups:
    """Group ends, written once as sorted ranges, with the sums of each range on the driver.

    ``groups`` has ``size`` and ``last``, a number that gives the order. Sums are made by tasks.
    """

    def __init__(self, groups: DataFrame):
        self.sums = written(groups.select("size", "last").repartitionByRange("last").sortWithinPartitions("last").mapInArrow(_running, "part int, upto bigint, rank bigint, size bigint, last bigint"), "groups")
        totals = self.sums.groupBy("part").agg(F.max("upto").alias("s"), F.max("rank").alias("n"), F.min("last").alias("first"), F.max("size").alias("most")).orderBy("first").collect()
        self.parts = [r["part"] for r in totals]
        self.ranks = np.concatenate([[0], np.cumsum([r["n"] for r in totals], dtype=np.int64)])
        before = np.concatenate([[0], np.cumsum([r["s"] for r in totals], dtype=np.int64)])
        self.total, self.count, self.most = int(before[-1]), int(self.ranks[-1]), max([r["most"] for r in totals], default=0)
        self.offsets = groups.sparkSession.createDataFrame(
            [(p, int(before[k]), int(self.ranks[k])) for k, p in enumerate(self.parts)], "part int, size_before bigint, rank_before bigint"
        )
        self.ends = self._ends(self.sums)

    def _ends(self, sums: DataFrame) -> DataFrame:
        return sums.join(F.broadcast(self.offsets), "part").select(
            (F.col("upto") + F.col("size_before")).alias("upto"), (F.col("rank") + F.col("rank_before")).alias("rank"), "last", "size"
        )

    def read(self, low: int, high: int, stride: int) -> list[tuple[int, int, int]]:
        """``(upto, rank, last)`` of every ``stride``-th rank above ``low`` and up to ``high``, and of ``high``; other ranges are not read."""
        a, b = np.searchsorted(self.ranks, [low, high - 1], side="right") - 1
        near = self._ends(self.sums.filter(F.col("part").isin(self.parts[a : b + 1])))
        rows = near.filter(F.col("rank").between(low + 1, high) & ((F.col("rank") % stride == 0) | (F.col("rank") == high)))
        return [tuple(r) for r in rows.select("upto", "rank", "last").orderBy("rank").collect()]

    def largest(self, n: int) -> list[tuple[int, int]]:
        """``(size, upto)`` of the ``n`` largest groups, largest first."""
        return [tuple(r) for r in self.ends.select("size", "upto").orderBy(F.desc("size"), "upto").limit(n).collect()]


class Lookup:
    """Group ends next to a running size: from a spaced choice of them, and closer reads inside one gap."""

    def __init__(self, groups: Groups, fences: int):
        self.groups, self.fences = groups, fences
        stride = max(1, -(-groups.count // fences))
        self.known = [(0, 0, 0), *groups.read(0, groups.count, stride)]

    def around(self, x: int) -> tuple[tuple[int, int, int], tuple[int, int, int]]:
        """The largest end up to ``x`` (0 is one), and the smallest above; ``x`` lies below the last end."""
        rows = self.known
        while True:
            k = bisect_right(rows, x, key=lambda r: r[0])
            a, b = rows[k - 1], rows[k]
            if b[1] - a[1] == 1:
                return a, b
            rows = [a, *self.groups.read(a[1], b[1], max(1, -(-(b[1] - a[1]) // self.fences)))]


def minimax_cuts(groups: DataFrame, shards: int, fences: int = FENCES) -> tuple[int, list[tuple[int, int]]]:
    """Smallest capacity, and for each shard, filled as far as it goes, the end of its last group: (running size, ``last``).

    The driver holds at most about ``fences`` group ends at a time: from a spaced choice it
    brackets the capacity and each cut, and reads on only inside the brackets.
    """
    return _minimax(Groups(groups), shards, fences)


def _minimax(groups: Groups, shards: int, fences: int) -> tuple[int, list[tuple[int, int]]]:
    if not groups.count:
        return 0, []
    ends, total, count, most = groups.ends, groups.total, groups.count, groups.most
    low, high = max(most, -(-total // shards)), total
    inside, stride, brackets, starts = F.lit(True), max(1, -(-count // fences)), [(0, total)], [0]
    while True:
        spaced = (F.col("rank") % stride == 0) | F.col("upto").isin(starts) | (F.col("rank") == count)
        known = [(0, 0, 0), *ends.filter(inside & spaced).select("upto", "rank", "last").orderBy("rank").collect()]
        near = Ends(np.array([r[0] for r in known], np.int64), np.array([r[1] for r in known], np.int64), brackets if stride == 1 else [])
        high = near.smallest(low, high, shards, hopeful=False)
        low = near.smallest(low, high, shards, hopeful=True)
        sure, at_most = near.cuts(low, shards), near.cuts(high, shards, hopeful=True)
        if low == high and sure == at_most:
            last = {r[0]: r[2] for r in known}
            return high, [(e, last[e]) for e in sure]
        # A cut lies between its two bounds: look there only, and more closely.
        brackets, starts = sorted(set(zip(sure, at_most, strict=True))), sorted(set(sure))
        inside = F.col("rank") == count
        for a, b in brackets:
            inside = inside | F.col("upto").between(a, b)
        stride = max(1, min(stride // 2, -(-ends.filter(inside).count() // fences)))


def fair_share(size: int, shards: int, largest: list[int]) -> float:
    """Bytes of a shard if ``size`` is spread over ``shards``: groups above an equal share, largest first, take a shard of their own."""
    for big in largest:
        if shards == 1 or big * shards <= size:
            break
        size, shards = size - big, shards - 1
    return size / shards


def level_cuts(groups: DataFrame, shards: int, fences: int = FENCES) -> tuple[int, list[tuple[int, int]]]:
    """Smallest capacity, and cuts under it with shards of near equal size; none is empty if there are as many groups.

    Each cut is the group end nearest to a fair share of what remains. It is moved where the
    shard would exceed the capacity or have no group, or where the rest would not fit the
    shards that remain or leave one of them without a group.
    """
    table = Groups(groups)
    capacity, _ = _minimax(table, shards, fences)
    if not table.count:
        return 0, []
    count, total = table.count, table.total
    tail = {r[1]: r for r in table.read(max(0, count - shards), count, 1)}
    if count <= shards:
        return capacity, [tail[min(k, count)][::2] for k in range(1, shards + 1)]
    near, big = Lookup(table, fences), table.largest(shards)
    # From the back: the smallest end whose rest fits the last 0, 1, 2, ... shards.
    least = [tail[count]]
    while len(least) < shards:
        x = least[-1][0] - capacity
        least.append((0, 0, 0) if x <= 0 else near.around(x - 1)[1])
    at, cuts = (0, 0, 0), []
    for left in range(shards - 1, 0, -1):
        share = fair_share(total - at[0], left + 1, [s for s, upto in big if upto > at[0]])
        want = at[0] + min(share, capacity)
        # The last end is above any wish, as at least one group per shard is left.
        below, above = near.around(min(int(want), total - 1))
        full = above[0] > at[0] + capacity
        at_best = below if below[0] > at[0] and (full or want - below[0] <= above[0] - want) else above
        at = max(at_best, least[left])
        at = min(at, tail[count - left])
        cuts.append((at[0], at[2]))
    return capacity, [*cuts, (total, tail[count][2])]


ROW_BITS = (1 << 33) - 1


def numbered_in_order(df: DataFrame, *order: str) -> DataFrame:
    """Add ``_rn``, the place of each row in global order, from 1.

    The sorted rows are written once, so partitions and the order within are fixed even if an executor is lost. Partition
    sizes are then counted, one row per partition, and each row adds its place in its own.
    """
    placed = (
        cut_lineage(df.orderBy(*order))
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = placed.join(F.broadcast(starts), "_part").withColumn("_rn", F.col("_start") + F.col("_place") + 1)
    return numbered.drop("_part", "_place", "_start")


def shard(docs: DataFrame, id: str = "doc_id", text: str = "text", shards: int = SHARDS, fences: int = FENCES) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot`` for each row; equal texts stay together.

    A row's size is its UTF-8 bytes plus 8 (NULL text has none). Groups of equal texts, told by
    two 64-bit hashes, are ordered by these hashes and are never split; shards are runs of
    groups, the largest shard is as small as any such cut allows, and the others are of near
    equal size (``level_cuts``). Within a shard, slots follow the order of groups, then ids (NULL
    first). Repeated rows take a slot each. Only with fewer groups than shards do the last shards
    stay empty; an empty table gives no rows.
    """
    body = F.col(text)
    rows = docs.select(
        F.col(id).alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(body.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(body).alias("_g1"),
        F.xxhash64(F.lit(1), F.coalesce(body, F.lit("")), body.isNull()).alias("_g2"),
    )
    numbered = numbered_in_order(rows, "_g1", "_g2", "doc_id")
    groups = numbered.groupBy("_g1", "_g2").agg(F.sum("size").alias("size"), F.max("_rn").alias("last"))
    _, cuts = level_cuts(groups, shards, fences)
    last = [0, *[n for _, n in cuts]]
    number = F.lit(0)
    for n in last[1:-1]:
        number = number + (F.col("_rn") > n).cast("int")
    start = F.element_at(F.array(*[F.lit(n).cast("long") for n in last[: max(1, len(last) - 1)]]), number + 1)
    return numbered.select("doc_id", "size", "text_crc32", number.alias("shard"), (F.col("_rn") - 1 - start).alias("slot"))


def sharded(docs: DataFrame) -> DataFrame:
    return shard(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
