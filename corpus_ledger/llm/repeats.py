"""Windows that occur more than once: anchors, the count-min filter on them, and runs of windows.

A text is a sequence of items, words or bytes. Each window of ``width`` items is keyed by its
anchor, the least hash among the shorter runs of ``inner`` items in it. Equal windows have equal
anchors in equal places, so a window can occur twice only if its anchor does, and there are far
fewer anchors than windows. Consecutive windows with one anchor form a run; a run's content is
the items its windows cover. A count-min sketch of anchors tells which runs to look at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import buffers
from .tables import opened, shared, written

#: Rows of the count-min sketch and cells in each; both bound the merged sketch.
ROWS = 2
CELL_BITS = 30
#: Most bits of each row of the filter that is sent to tasks; past it more windows pass, none is lost.
FILTER_BITS = 28


SLICE = 1 << 19  # small enough for the sliding minimum to stay in the cache


class Runs:
    """Runs of windows of one slice: ``keys`` (anchor hash), ``start`` (item), ``length`` (windows), ``text``.

    The anchor is the leftmost of equal hashes, so no two windows of a run can be equal, and a
    run has at most ``width - inner + 1`` windows.
    """

    def __init__(self, codes: np.ndarray, at: np.ndarray, width: int, inner: int):
        sizes = np.diff(at)
        self.keys = np.zeros(0, buffers.U64)
        self.start = self.length = self.text = np.zeros(0, np.int64)
        if sizes.max(initial=0) < width:
            return
        n, shorter = len(codes) - width + 1, len(codes) - inner + 1
        begin = np.arange(shorter)
        hashes = buffers.run_hashes(codes, begin, begin + inner)
        least = buffers.sliding_min(hashes, width - inner + 1)
        valid = begin[:n] + width <= np.repeat(at[1:], sizes)[:n]  # does not cross texts
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | (hashes[: n - 1] == least[:-1])
        first = at[:-1][sizes >= width]
        new[first] = True
        self.start = np.flatnonzero(new)
        passed = np.concatenate([[0], np.cumsum(valid)])
        self.length = np.diff(np.append(passed[self.start], passed[-1]))
        self.keys = least[self.start]
        self.text = np.searchsorted(at, self.start, side="right") - 1


def cells_of(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """Cell of each key in each row of a sketch."""
    return [(buffers.mix(keys + buffers.U64(k * 0x632BE59BD9B4E019)) >> buffers.U64(64 - bits)).astype(np.int64) for k in range(ROWS)]


class Filter:
    """One bit for each cell: was its count two or more?"""

    def __init__(self, bits: int, rows: list[np.ndarray]):
        self.bits, self.rows = bits, rows

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        """False only for keys that occur once."""
        found = np.ones(len(keys), bool)
        for cells, row in zip(cells_of(keys, self.bits), self.rows, strict=True):
            found &= (row[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1
        return found


def count_min_filter(docs: DataFrame, anchors: Callable) -> Filter:
    """Merge the sketches of all partitions, and keep which cells count two or more.

    ``anchors`` turns Arrow batches of ``docs`` into arrays of keys. A partition's sketch is sent
    as its filled cells with counts up to two; Spark adds the counts up.
    """

    @buffers.lean
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def filled(parts):
            keys = np.concatenate(parts) if parts else np.zeros(0, buffers.U64)
            for k, cells in enumerate(cells_of(keys, CELL_BITS)):
                cell, count = np.unique(cells, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell | k << CELL_BITS), pa.array(np.minimum(count, 2))], names=["cell", "n"])

        parts, held = [], 0
        for keys in anchors(batches):
            parts.append(keys)
            held += len(keys)
            if held > 2_000_000:
                yield from filled(parts)
                parts, held = [], 0
        yield from filled(parts)

    spark = docs.sparkSession
    merged = docs.mapInArrow(sketch, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    repeated = written(merged.filter("n >= 2").select("cell"), "repeated")
    bits = min(FILTER_BITS, max(16, (16 * repeated.count()).bit_length()))
    rows = _packed(repeated, bits)
    return Filter(bits, rows)


def _packed(cells: DataFrame, bits: int) -> list[np.ndarray]:
    """The filter's rows, put together from pieces of at most 64 kB that tasks fill."""
    shift, piece_bits = CELL_BITS - bits, min(19, bits)

    @buffers.lean
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[int, np.ndarray] = {}
        for batch in batches:
            cell = np.asarray(batch.column(1))
            row, cell = cell >> CELL_BITS, (cell & ((1 << CELL_BITS) - 1)) >> shift
            piece = row << 32 | cell >> piece_bits
            for p in np.unique(piece).tolist():
                own = np.unique(cell[piece == p] & ((1 << piece_bits) - 1))
                have = pieces.setdefault(p, np.zeros(1 << piece_bits, np.uint8))
                have[own] = 1
        for p, have in pieces.items():
            yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([np.packbits(have, bitorder="little").tobytes()])], names=["piece", "body"])

    piece = F.shiftright("cell", shift + piece_bits)
    found = cells.select(piece.alias("piece"), "cell").repartition("piece").mapInArrow(pack, "piece bigint, body binary").collect()
    rows = [np.zeros(1 << (bits - 3), np.uint8) for _ in range(ROWS)]
    for r in found:
        at = (r["piece"] & 0xFFFFFFFF) << (piece_bits - 3)
        rows[r["piece"] >> 32][at : at + (1 << (piece_bits - 3))] |= np.frombuffer(r["body"], np.uint8)
    return rows


class Kind:
    """How texts are cut into items, and the window and anchor sizes."""

    def __init__(self, words: bool, width: int, inner: int):
        self.words, self.width, self.inner = words, width, inner

    def items(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code of every item, and the place of each text's first."""
        if not self.words:
            return buffers.byte_codes(data), offsets
        starts, ends, at = buffers.word_spans(data, offsets, buffers.separators())
        return buffers.word_hashes(data, starts, ends), at

    def anchors(self, batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, data, offsets in buffers.slices(batches, "text", SLICE):
            yield Runs(*self.items(data, offsets), self.width, self.inner).keys

    def kept(self, body: bytes, removed: np.ndarray | None) -> tuple[int, str]:
        """Number of items, and the digest of those that stay."""
        if self.words:
            words = body.split()
            stay = words if removed is None else [w for w, gone in zip(words, removed.tolist(), strict=True) if not gone]
            return len(words), hashlib.sha256(b" ".join(stay)).hexdigest()
        left = body if removed is None else np.frombuffer(body, np.uint8)[~removed].tobytes()
        return len(body), hashlib.sha256(left).hexdigest()


LISTS = "start array<int>, length array<int>, key array<bigint>, content array<bigint>, windows array<array<bigint>>"


def candidate_runs(docs: DataFrame, kind: Kind, whole: bool = False) -> DataFrame:
    """One row per document, written once: ``row``, ``doc_id``, ``n_items``, and its runs with repeated anchors.

    A document without such runs is finished: it has the digest of its text, and no text unless
    ``whole`` asks for it. ``content`` is a hash of the run's items; for words, ``windows`` lists
    the hashes of each run's windows.
    """
    spark = docs.sparkSession
    wanted = shared(spark, count_min_filter(docs.select("text"), kind.anchors))

    @buffers.lean
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        filter_ = opened(Filter, wanted)
        for batch, data, offsets in buffers.slices(batches, "text", SLICE):
            n = batch.num_rows
            codes, at = kind.items(data, offsets)
            runs = Runs(codes, at, kind.width, kind.inner)
            on = filter_.repeated(runs.keys)
            start, length, key, text = runs.start[on], runs.length[on], runs.keys[on], runs.text[on]
            content = buffers.run_hashes(codes, start, start + length + kind.width - 1) if len(start) else key
            per_text = np.bincount(text, minlength=n)
            if kind.words:
                begin = np.repeat(start, length) + buffers.places(length)
                window = buffers.run_hashes(codes, begin, begin + kind.width) if len(begin) else key
            else:
                window = np.zeros(0, buffers.U64)
            windows = buffers.lists(buffers.signed(window), length if kind.words else np.zeros(len(length), np.int64), pa.int64())
            bodies, digests, sizes = [], [], np.diff(at)
            for k in range(n):
                body = None if per_text[k] and not whole else data[offsets[k] : offsets[k + 1]].tobytes()
                digests.append(None if per_text[k] else kind.kept(body, None)[1])
                bodies.append(data[offsets[k] : offsets[k + 1]].tobytes() if per_text[k] or whole else None)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + n)),
                    batch.column(batch.schema.get_field_index("doc_id")),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(bodies, pa.binary()),
                    buffers.lists(start - at[text], per_text, pa.int32()),
                    buffers.lists(length, per_text, pa.int32()),
                    buffers.lists(buffers.signed(key), per_text, pa.int64()),
                    buffers.lists(buffers.signed(content), per_text, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_text)]), pa.int32()), windows),
                ],
                names=["row", "doc_id", "n_items", "digest", "body", "start", "length", "key", "content", "windows"],
            )
            row += n

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row bigint, doc_id {id_kind}, n_items bigint, digest string, body binary, {LISTS}"
    return written(docs.select("doc_id", "text").mapInArrow(mark, schema), "runs")


def occurrences(found: DataFrame) -> DataFrame:
    """One row per run: ``row``, ``start``, ``length``, ``key``, ``content``."""
    return found.filter(F.size("key") > 0).select("row", F.inline(F.arrays_zip("start", "length", "key", "content")))


def contents(runs: DataFrame) -> DataFrame:
    """Distinct contents: ``key``, ``content``, ``length``, how often each occurs (``n``), and one place (``row``, ``start``)."""
    place = F.min(F.struct("row", "start")).alias("at")
    return (
        runs.groupBy("key", "content")
        .agg(F.max("length").alias("length"), F.count(F.lit(1)).alias("n"), place)
        .select("key", "content", "length", "n", "at.row", "at.start")
    )


def shared_anchors(distinct: DataFrame) -> DataFrame:
    """Anchors of more than one content (``key``, ``contents``): there, windows of different contents can be equal."""
    return distinct.groupBy("key").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1")


SPANS = "array<struct<from:int,to:int>>"


def whole_runs(distinct: DataFrame) -> DataFrame:
    """Contents that occur twice or more: each of their windows does (``key``, ``content``, ``spans``)."""
    return distinct.filter("n > 1").select("key", "content", F.expr(f"CAST(array(named_struct('from', 0, 'to', length)) AS {SPANS})").alias("spans"))


def removal(found: DataFrame, runs: DataFrame, repeated: DataFrame, kind: Kind, whole: bool = False, valid: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``n_items``, ``n_removed``, ``n_spans``, ``kept_sha256``; with ``whole``, ``kept``.

    With ``valid``, ``kept`` is without bytes that are no whole UTF-8 characters.

    ``repeated`` tells for contents which windows (``spans`` within the run) occur more than once.
    """
    spans = (
        runs.select("row", "start", "key", "content")
        .join(repeated, ["key", "content"])
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "spans")).alias("hits"))
    )
    width = kind.width

    @buffers.lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, n, digest, body, hits in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                gone, n_spans = None, 0
                if hits:
                    edge = np.zeros(n + 1, np.int32)
                    for h in hits:
                        for s in h["spans"]:
                            edge[h["start"] + s["from"]] += 1
                            edge[min(n, h["start"] + s["to"] + width - 1)] -= 1
                    gone = np.cumsum(edge[:-1]) > 0
                    n_spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                if gone is not None or digest is None:
                    digest = kind.kept(body, gone)[1]
                kept = None
                if whole:
                    kept = body if gone is None else np.frombuffer(body, np.uint8)[~gone].tobytes()
                    kept = kept.decode(errors="ignore").encode() if valid else kept
                out.append((doc_id, n, 0 if gone is None else int(gone.sum()), n_spans, digest, kept))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "n_items", "n_removed", "n_spans", "kept_sha256", "kept"]
            )

    id_kind = found.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_kind}, n_items bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    touched = found.filter(F.size("key") > 0).select("row", "doc_id", "n_items", "digest", "body")
    changed = touched.join(spans, "row", "left").drop("row").mapInArrow(cut, schema)
    done = found.filter(F.size("key") == 0).select(
        "doc_id", "n_items", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.col("digest").alias("kept_sha256"), F.col("body").alias("kept"),
    )
    return changed.unionByName(done)
