"""Benchmark decontamination: test phrases are searched in an FM-index of each training shard.

A shard is a run of documents with at most ``buffers.SLICE_BYTES`` of text, inside one task.
Its words are numbered by the test vocabulary. A word no phrase has separates; runs between
separators that are shorter than the shortest phrase hold none and are left out of the index,
which loses nothing. Words are matched by length and a 64-bit hash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import buffers
from .fm_index import FMIndex
from .tables import opened, shared, written

WINDOW_WORDS = 13
#: Phrases searched in one pass over the documents; more are searched in further passes.
PASS_PHRASES = 500_000
OUTSIDE = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
LOWER = bytes(buffers.lower_ascii())

SPANS = "array<struct<start:bigint,end:bigint,first_word:bigint,end_word:bigint>>"


def windows(text: str | None, size: int = WINDOW_WORDS) -> list[tuple[bytes, ...]]:
    """All runs of ``size`` words of a text; a shorter text is one run, a text without words has none."""
    words = WORD.findall((text or "").encode().translate(LOWER))
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


class Phrases:
    """Distinct phrases of one pass with their items, ready to be sent to every task."""

    def __init__(self, items: dict[tuple[bytes, ...], set[str]]):
        phrases = sorted(items)
        words = sorted({w for p in phrases for w in p})
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words]).astype(np.int64)
        starts = ends - np.array([len(w) for w in words], np.int64)
        hashes = buffers.word_hashes(data, starts, ends)
        order = np.argsort(hashes, kind="stable")
        number = {words[j]: k + 2 for k, j in enumerate(order)}
        self.hashes, self.sizes = hashes[order], (ends - starts)[order]
        self.items = [sorted(items[p]) for p in phrases]
        self.lengths = np.array([len(p) for p in phrases], np.int64)
        width = max(map(len, phrases), default=0)
        self.symbols = np.zeros((len(phrases), width), np.int64)
        for k, p in enumerate(phrases):
            self.symbols[k, width - len(p) :] = [number[w] for w in p]
        self.shortest = int(self.lengths.min()) if len(phrases) else 0

    def numbers(self, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of each word, 1 for words no phrase has."""
        if not len(self.hashes):
            return np.ones(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = (self.hashes[at] == hashes) & (self.sizes[at] == sizes)
        return np.where(known, at + 2, 1)


def passes(benchmark: DataFrame, id: str, text: str, most: int) -> Iterator[Phrases]:
    """Phrases of the benchmark in groups of at most ``most``; one group is on the driver at a time."""
    items: dict[tuple[bytes, ...], set[str]] = {}
    for row in benchmark.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t")).toLocalIterator():
        for phrase in windows(row["t"]):
            items.setdefault(phrase, set()).add(row["i"])
            if len(items) >= most:
                yield Phrases(items)
                items = {}
    yield Phrases(items)


def search_shard(data: np.ndarray, offsets: np.ndarray, phrases: Phrases, spans: tuple[np.ndarray, ...]):
    """Which words of the shard are inside an occurrence of a phrase, and ``{text: items}``."""
    starts, ends, at = spans
    n_words, hit = np.diff(at), np.zeros(len(starts), bool)
    items: dict[int, set[str]] = {}
    if not len(starts) or not len(phrases.lengths):
        return hit, items
    number = phrases.numbers(buffers.word_hashes(data, starts, ends), ends - starts)
    # A run ends where a word is unknown or a text begins.
    known = number > 1
    new = np.ones(len(number), bool)
    new[1:] = ~known[1:] | ~known[:-1]
    new[at[:-1][n_words > 0]] = True
    run = np.cumsum(new) - 1
    kept = np.flatnonzero(known & (np.bincount(run)[run] >= phrases.shortest))
    if not len(kept):
        return hit, items
    # One separator before each run; ``word`` is the shard's word in each place of the sequence.
    place = np.arange(len(kept)) + np.cumsum(new[kept])
    symbols = np.ones(place[-1] + 1, np.int64)
    symbols[place] = number[kept]
    word = np.zeros(len(symbols), np.int64)
    word[place] = kept
    index = FMIndex(symbols, len(phrases.hashes) + 1)
    own, low, high = index.search(phrases.symbols, phrases.lengths)
    phrase = np.repeat(own, high - low)
    begin = word[index.locate(np.repeat(low, high - low) + buffers.places(high - low))]
    text = np.searchsorted(at, begin, side="right") - 1
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + phrases.lengths[phrase], -1)
    hit = np.cumsum(cover[:-1]) > 0
    for t, p in np.unique(np.stack([text, phrase], 1), axis=0).tolist():
        items.setdefault(t, set()).update(phrases.items[p])
    return hit, items


def merged_spans(hit: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, offsets: np.ndarray):
    """Text and span of every maximal run of hit words; runs do not cross texts."""
    edge = np.zeros(len(hit) + 1, bool)
    edge[at] = True
    first, last = hit & edge[:-1], hit & edge[1:]
    first[1:] |= hit[1:] & ~hit[:-1]
    last[:-1] |= hit[:-1] & ~hit[1:]
    f, e = np.flatnonzero(first), np.flatnonzero(last)
    text = np.searchsorted(at, f, side="right") - 1
    return text, starts[f] - offsets[text], ends[e] - offsets[text], f - at[text], e + 1 - at[text]


def _step(phrases):
    lower, outside = buffers.lower_ascii(), buffers.separators(OUTSIDE)

    @buffers.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = opened(Phrases, phrases)
        for batch, data, offsets in buffers.slices(batches, "text"):
            data = lower[data]
            words = buffers.word_spans(data, offsets, outside)
            starts, ends, at = words
            hit, items = search_shard(data, offsets, wanted, words)
            before = batch.column(batch.schema.get_field_index("spans")).to_pylist()
            for k, old in enumerate(before):
                for x in old:
                    hit[at[k] + x["first_word"] : at[k] + x["end_word"]] = True
            items_before = batch.column(batch.schema.get_field_index("items")).to_pylist()
            text, *span = merged_spans(hit, starts, ends, at, offsets)
            total = np.concatenate([[0], np.cumsum(hit)])
            per_text = np.bincount(text, minlength=batch.num_rows)
            list_at = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)
            kind = batch.schema.field("spans").type.value_type
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.diff(at), pa.int64()),
                    pa.array(total[at[1:]] - total[at[:-1]], pa.int64()),
                    pa.array([sorted(items[k].union(old)) if k in items else old for k, old in enumerate(items_before)], pa.list_(pa.string())),
                    pa.ListArray.from_arrays(pa.array(list_at), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in span], fields=list(kind))),
                ],
                names=batch.schema.names,
            )

    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", most: int = PASS_PHRASES
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text``, word counts, items found, merged spans to remove.

    ``items`` holds distinct item ids as strings (a NULL id is the empty string); ``spans`` give
    byte and word ranges. NULL and empty texts have no words; an empty benchmark finds nothing;
    repeated rows each come out. A benchmark of more than ``most`` distinct windows takes several
    passes over the documents, each adding to the hits of the one before.
    """
    spark = docs.sparkSession
    nothing = ["0L AS n_words", "0L AS n_hit", "CAST(array() AS array<string>) AS items", f"CAST(array() AS {SPANS}) AS spans"]
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).selectExpr("*", *nothing)
    for k, group in enumerate(passes(benchmark, item, item_text, most)):
        rows = (rows if k == 0 else written(rows, "decontaminate")).mapInArrow(_step(shared(spark, group)), rows.schema)
    return rows


def is_contaminated() -> Column:
    """At least one hit word, and hits of a twentieth of the words or more."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, as they are."""
    packed = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("doc_id"), "text")
    return contamination(packed, benchmark).filter(~is_contaminated()).select("doc_id.*", "text").select(*docs.columns)
