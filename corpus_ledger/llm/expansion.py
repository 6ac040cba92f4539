"""Suffix-array dedup: equal byte windows read off a Burrows-Wheeler transform by interval expansion.

Contents that share an anchor are joined to one sequence and sorted by their first ``width``
bytes. Starting from all suffixes, intervals are extended backwards one byte at a time, breadth
first: extending the interval of a string of length l ends where neighbouring suffixes have just
l bytes in common, unless a shorter length was found there before. So common prefixes appear in
increasing order, each once, and the search ends at length ``width``. Suffixes with no border
between them share ``width`` bytes or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import buffers, repeats
from .fm_index import WaveletMatrix
from .tables import release, unused, written

WINDOW_BYTES = 400
ANCHOR_BYTES = 200
#: Bytes that are sorted together at least, as far as a task has them.
SORTED_BYTES = 1 << 20
#: Contents of one anchor that are sorted together at most; anchors with more are cut finer first.
CROWD = 4000
FINER = (25, 1)


def bounded_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by at least their first ``depth`` symbols (below 256); the end sorts first."""
    n = len(symbols)
    key = np.zeros(n, np.uint64)
    for j in range(min(7, n)):
        key[: n - j] |= (symbols[j:].astype(np.uint64) + np.uint64(1)) << np.uint64(9 * (6 - j))
    width = 7
    # Places and ranks take four bytes each; only the sorting keys are wider.
    order = np.argsort(key).astype(np.int32)
    while True:
        new = np.ones(n, np.int32)
        new[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int32)
        rank[order] = np.cumsum(new, dtype=np.int32)
        if width >= depth or rank[order[-1]] == n:
            return order
        del order, new
        key = rank.astype(np.int64) * (n + 1)
        key[: max(0, n - width)] += rank[width:]
        order = np.argsort(key).astype(np.int32)
        width *= 2


def equal_windows(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """A class for every position: equal for positions of windows with equal bytes.

    Only positions whose window lies within its content count; others get arbitrary classes, but
    never one of two different windows that count.
    """
    present = np.flatnonzero(np.bincount(data, minlength=256))
    dense = np.zeros(256, np.int16)
    dense[present] = np.arange(2, len(present) + 2)
    # 0 ends the sequence, 1 stands before each content.
    sequence = np.ones(len(data) + len(offsets), np.int16)
    place = np.arange(len(data), dtype=np.int32) + np.repeat(np.arange(1, len(offsets), dtype=np.int32), np.diff(offsets))
    sequence[place] = dense[data]
    sequence[-1] = 0
    n = len(sequence)
    order = bounded_order(sequence, width)
    before = WaveletMatrix(sequence[order - 1], len(present) + 1)
    first = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=len(present) + 2))])
    border = np.zeros(n + 1, bool)
    border[[0, n]] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(width):
        if not len(low):
            break
        _, symbol, lo, hi = before.children(low, high)
        inner = symbol > 1
        symbol = symbol[inner]
        low, high = first[symbol] + lo[inner], first[symbol] + hi[inner]
        fresh = ~border[high]
        low, high = low[fresh], high[fresh]
        border[high] = True
    del before, sequence
    classes = np.empty(n, np.int32)
    classes[order] = np.cumsum(border[:-1], dtype=np.int32)
    return classes[place]


def repeated_spans(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, width: int) -> list[list[dict]]:
    """For each content, spans of windows that occur more than once, contents counted by weight."""
    classes = equal_windows(data, offsets, width)
    sizes = np.diff(offsets)
    left = np.repeat(offsets[1:], sizes) - np.arange(len(data))
    weight = np.where(left >= width, np.repeat(weights, sizes), 0)
    del left
    often = (np.bincount(classes, weights=weight)[classes] > 1) & (weight > 0)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        edge = np.diff(np.concatenate([[0], often[a:b].astype(np.int8), [0]]))
        out.append([{"from": int(f), "to": int(t)} for f, t in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)])
    return out


def _expanded(width: int):
    """Rows (key, content, n, bytes) sorted by key: whole keys are gathered up to a size and sorted together."""
    kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))

    def solve(keys, ids, weights, bodies):
        offsets = np.concatenate([[0], np.cumsum([len(b) for b in bodies])]).astype(np.int64)
        spans = repeated_spans(np.frombuffer(b"".join(bodies), np.uint8), offsets, np.array(weights, np.int64), width)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array(spans, kind)], names=["key", "content", "spans"])

    @buffers.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if size >= SORTED_BYTES and row[0] != held[-1][0]:
                    yield solve(*zip(*held, strict=True))
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solve(*zip(*held, strict=True))

    return run


@buffers.lean
def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the runs listed with each body."""
    for batch in batches:
        out = []
        for body, runs in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            out += [(r["key"], r["content"], r["n"], body[r["start"] : r["end"]]) for r in runs]
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["key", "content", "n", "bytes"])


FINER_ROWS = "key bigint, content bigint, n bigint, anchor bigint, at int, length int, core bigint, piece bigint, bytes binary"


def _finer(width: int, inner: int, step: int):
    """Cut contents of crowded anchors into pieces of at most ``step`` windows, keyed by what their windows have in common.

    Places are counted from the anchor, so equal windows fall into pieces with equal cores.
    """

    @buffers.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "content", "n", "anchor", "at", "length", "core", "piece", "bytes"]
        kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64()] * 2 + [pa.binary()]
        for batch in batches:
            out = []
            for key, content, n, body, anchor in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                codes = buffers.byte_codes(np.frombuffer(body, np.uint8))
                if anchor is None:
                    begin = np.arange(len(codes) - inner + 1)
                    anchor = int(np.flatnonzero(buffers.signed(buffers.run_hashes(codes, begin, begin + inner)) == key)[0])
                last = len(codes) - width
                k = -anchor // step
                while k * step + anchor <= last:
                    a, b = max(0, anchor + k * step), min(last, anchor + (k + 1) * step - 1)
                    core = (anchor + (k + 1) * step - 1, anchor + k * step + width)
                    ends = np.array([core, (a, b + width)], np.int64)
                    core_hash, piece = buffers.signed(buffers.run_hashes(codes, ends[:, 0], ends[:, 1])).tolist()
                    out.append((key, content, n, anchor - a, a, b - a + 1, core_hash ^ (k * 0x1F123BB5), piece, body[a : b + width]))
                    k += 1
            columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return run


def _spans_of_contents(found: DataFrame, distinct: DataFrame) -> DataFrame:
    """``key``, ``content``, ``spans`` for contents that share their anchor with others."""
    shared = repeats.shared_anchors(distinct)
    # One occurrence of each content is cut out of its text.
    end = (F.col("start") + F.col("length") + WINDOW_BYTES - 1).alias("end")
    wanted = distinct.join(shared, "key").groupBy("row").agg(F.collect_list(F.struct("key", "content", "n", "start", end)).alias("cuts"))
    pieces = written(
        found.select("row", "body").join(wanted, "row").select("body", "cuts").mapInArrow(_cut_out, "key bigint, content bigint, n bigint, bytes binary"), "pieces"
    )
    crowds = shared.filter(F.col("contents") > CROWD).select("key")
    solved = _solve(pieces.join(crowds, "key", "left_anti"))
    level = pieces.join(crowds, "key", "left_semi").withColumn("anchor", F.lit(None).cast("bigint"))
    # Places of the present pieces in the contents they were first cut from.
    places = level.select(F.col("key").alias("key0"), F.col("content").alias("content0"), F.lit(0).alias("at0"), "key", "content")
    for step in FINER:
        if level.isEmpty():
            break
        cut = written(level.mapInArrow(_finer(WINDOW_BYTES, ANCHOR_BYTES, step), FINER_ROWS), "finer")
        places = places.join(cut.select("key", "content", "at", "core", "piece"), ["key", "content"]).select(
            "key0", "content0", (F.col("at0") + F.col("at")).alias("at0"), F.col("core").alias("key"), F.col("piece").alias("content")
        )
        one = cut.groupBy(F.col("core").alias("key"), F.col("piece").alias("content")).agg(
            F.sum("n").alias("n"), F.max("length").alias("length"), F.first("bytes").alias("bytes"), F.first("anchor").alias("anchor")
        )
        one = written(one, "pieces")
        shared = repeats.shared_anchors(one)
        crowds = shared.filter(F.col("contents") > CROWD).select("key")
        parts = repeats.whole_runs(one)
        if step > 1:
            parts = parts.unionByName(_solve(one.join(shared.select("key"), "key", "left_semi").join(crowds, "key", "left_anti")))
        moved = F.expr(f"CAST(transform(spans, s -> named_struct('from', s.from + at0, 'to', s.to + at0)) AS {repeats.SPANS})")
        solved = solved.unionByName(
            places.join(parts, ["key", "content"]).select(F.col("key0").alias("key"), F.col("content0").alias("content"), moved.alias("spans"))
        )
        level = one.join(crowds, "key", "left_semi").select("key", "content", "n", "bytes", "anchor")
    return solved.groupBy("key", "content").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _solve(pieces: DataFrame) -> DataFrame:
    # Sorting costs far more than its bytes tell, so the tasks are not put together by size.
    tasks = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = pieces.select("key", "content", "n", "bytes").repartition(tasks, "key").sortWithinPartitions("key", "content")
    return ordered.mapInArrow(_expanded(WINDOW_BYTES), f"key bigint, content bigint, spans {repeats.SPANS}")


def repeated_bytes(docs: DataFrame, id: str = "doc_id", text: str = "text", whole: bool = False, valid: bool = False) -> DataFrame:
    """One row per row of ``docs``: bytes, removed bytes, maximal removed runs, digest of the bytes that stay.

    A byte goes if a window of 400 bytes over it also starts anywhere else, in the same text or
    another; windows do not cross texts. With ``whole``, ``kept`` holds the bytes that stay, which
    need not be UTF-8; with ``valid``, what is left of cut characters is dropped there. NULL and empty texts have no bytes; repeated rows are documents of their
    own. Copies of a run of windows are one content with a count. A content that is alone under
    its anchor is decided by that count, contents that share an anchor by interval expansion.
    """
    kind = repeats.Kind(words=False, width=WINDOW_BYTES, inner=ANCHOR_BYTES)
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    found = repeats.candidate_runs(rows, kind, whole)
    release(docs.sparkSession)
    runs = repeats.occurrences(found)
    distinct = written(repeats.contents(runs), "contents")
    solved = written(_spans_of_contents(found, distinct), "spans")
    release(docs.sparkSession)
    # The expansion sees counts, so it also tells what is whole; the rest is alone under its anchor.
    alone = repeats.whole_runs(distinct.join(solved.select("key", "content"), ["key", "content"], "left_anti"))
    return repeats.removal(found, runs, solved.unionByName(alone), kind, whole, valid)


def deduplicated_bytes(docs: DataFrame) -> DataFrame:
    return repeated_bytes(docs).select("doc_id", F.col("n_items").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")


def without_repeats(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with repeated bytes, and what is left of cut characters, taken out of ``text``.

    ``n_chars``, where there is one, counts what is left. NULL texts stay NULL.
    """
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    null = unused(docs, "_null")
    packed = docs.select(F.struct(*others, F.col("text").isNull().alias(null)).alias("doc_id"), "text")
    found = repeated_bytes(packed, whole=True, valid=True).select("doc_id.*", F.expr(f"IF(doc_id.{null}, NULL, CAST(kept AS string))").alias("text"))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)
