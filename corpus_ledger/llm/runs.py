"""Periodic runs of words, by Lyndon roots.

A run is a stretch with smallest period ``q`` that no neighbouring word extends. Every run holds a
Lyndon root: a stretch of ``q`` words that is the longest Lyndon word at its first place, either
under the order of the words or under the opposite one. So the work on one text is

1. the Lyndon array under both orders, straight from the first phase of Baier's suffix sorter:
   groups of places, taken from the highest to the lowest, lengthen the context of the nearest
   place before them that is still open; the context a place ends with is its longest Lyndon word;
2. each candidate root ``(i, i + q)`` extended to both sides by longest common extensions, found by
   binary search over hashes of stretches and then checked word by word.

Runs of four periods and six words lie in stretches whose three-word sequences each occur three
times: such a run has at least ``4q - 2`` starts of three words in ``q`` classes of equal ones. Only
those stretches are sorted; with weaker limits the whole text is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import buffers

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def lyndon_lengths(text: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each place (phase one of Baier's grouping, linear time).

    ``left`` and ``right`` link the places that are not grouped for good. When the members of the highest open
    group go, the link to the left of each leads to the nearest open place with a lower group: the
    place whose context the member's context continues.
    """
    n = len(text)
    slots = {symbol: g for g, symbol in enumerate(sorted(set(text)))}
    group = [slots[symbol] for symbol in text]
    members: list[list[int]] = [[] for _ in slots]
    for i, g in enumerate(group):
        members[g].append(i)
    context = [1] * len(slots)
    below = list(range(-1, len(slots) - 1))
    above = list(range(1, len(slots) + 1))
    above[-1:] = [-1] if slots else []
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    lengths = [0] * n
    g = len(slots) - 1
    while g >= 0:
        length = context[g]
        met: dict[int, int] = {}
        for i in members[g]:
            if group[i] != g:
                continue
            lengths[i] = length
            before, after = left[i], right[i]
            if after < n:
                left[after] = before
            if before >= 0:
                right[before] = after
                met[before] = met.get(before, 0) + 1
        parts: dict[tuple[int, int], list[int]] = {}
        for i, times in met.items():
            parts.setdefault((times, group[i]), []).append(i)
        # More repeats of the context rank higher, so they are put above the old group first.
        for times, old in sorted(parts, reverse=True):
            new, higher = len(context), above[old]
            context.append(context[old] + times * length)
            members.append(parts[times, old])
            below.append(old)
            above.append(higher)
            above[old] = new
            if higher >= 0:
                below[higher] = new
            for i in members[new]:
                group[i] = new
        g = below[g]
    return lengths


class Stretches:
    """Hashes of any stretch of a sequence, for longest common extensions of many pairs at once."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        self.powers = buffers.powers(self.n + 1)
        self.total = np.zeros(self.n + 1, buffers.U64)
        np.cumsum(buffers.mix(symbols.astype(buffers.U64) + buffers.U64(1)) * self.powers[: self.n], out=self.total[1:])

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Are the stretches of a length at ``a`` and at ``b >= a`` alike?"""
        return (self.total[a + length] - self.total[a]) * self.powers[b - a] == self.total[b + length] - self.total[b]

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest stretch that starts at both."""
        got = np.zeros(len(a), np.int64)
        for step in _steps(self.n):
            fits = np.flatnonzero(b + got + step <= self.n)
            fits = fits[self.same(a[fits] + got[fits], b[fits] + got[fits], np.int64(step))]
            got[fits] += step
        return got

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest stretch that ends before both."""
        got = np.zeros(len(a), np.int64)
        for step in _steps(self.n):
            fits = np.flatnonzero(a - got - step >= 0)
            fits = fits[self.same(a[fits] - got[fits] - step, b[fits] - got[fits] - step, np.int64(step))]
            got[fits] += step
        return got


def _steps(n: int) -> list[int]:
    return [1 << k for k in reversed(range(max(n, 1).bit_length()))]


def _is_run(symbols: np.ndarray, start: int, end: int, period: int) -> bool:
    return np.array_equal(symbols[start : end - period], symbols[start + period : end]) and (
        start == 0 or symbols[start - 1] != symbols[start - 1 + period]
    )


def _extended(symbols: np.ndarray, period: int, root: int) -> tuple[int, int]:
    """Bounds of the run around a root, word by word."""
    start, end = root, root + period
    while end < len(symbols) and symbols[end] == symbols[end - period]:
        end += 1
    while start > 0 and symbols[start - 1] == symbols[start - 1 + period]:
        start -= 1
    return start, end


def periodic_runs(symbols: np.ndarray, least_periods: int = 2, least_length: int = 2) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence with so many periods and symbols, by start and period."""
    n = len(symbols)
    if n < 2:
        return []
    text = symbols.tolist()
    highest = max(text)
    hashes = Stretches(symbols)
    roots = []
    for ordered in (text, [highest - s for s in text]):
        period = np.array(lyndon_lengths(ordered), np.int64)
        at = np.arange(n, dtype=np.int64)
        if least_periods >= 3:  # of three periods, one root at least is followed by a copy of itself
            some = np.flatnonzero(at + 2 * period <= n)
            some = some[hashes.same(some, some + period[some], period[some])]
        else:
            some = at[at + period < n]
        roots.append(np.stack([some, period[some]]))
    at, period = np.concatenate(roots, axis=1)
    start = at - hashes.backward(at, at + period)
    end = at + period + hashes.forward(at, at + period)
    long = np.flatnonzero((end - start >= least_periods * period) & (end - start >= least_length))
    found: dict[tuple[int, int, int], list[int]] = {}
    for s, e, p, root in zip(start[long].tolist(), end[long].tolist(), period[long].tolist(), at[long].tolist()):
        found.setdefault((s, e, p), []).append(root)
    out = set()
    for (s, e, p), places in found.items():
        # Hashes never end a run too early; where they join what differs, every root is extended by itself.
        bounds = [(s, e)] if _is_run(symbols, s, e, p) else [_extended(symbols, p, root) for root in places]
        out |= {(s, e - s, p) for s, e in bounds if e - s >= max(least_periods * p, least_length)}
    return sorted(out, key=lambda run: (run[0], run[2]))


def _recurring(symbols: np.ndarray) -> np.ndarray:
    """Which places start a three-word sequence that occurs three times."""
    width = int(symbols.max()) + 1
    pairs = np.unique(symbols[:-1] * width + symbols[1:], return_inverse=True)[1]
    _, kind, counts = np.unique(pairs[:-1] * width + symbols[2:], return_inverse=True, return_counts=True)
    return counts[kind] >= 3


def word_runs(words: list, least_periods: int = 4, least_length: int = 6) -> list[tuple[int, int, int]]:
    """Runs of a list of words."""
    if len(words) < max(least_length, 2):
        return []
    known: dict = {}
    symbols = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    if least_periods < 4 or least_length < 6:
        return periodic_runs(symbols, least_periods, least_length)
    edge = np.diff(np.concatenate([[0], _recurring(symbols).astype(np.int8), [0]]))
    firsts, lasts = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 2
    long = lasts - firsts >= least_length
    firsts, lasts = firsts[long], lasts[long]
    if not len(firsts):
        return []
    # The stretches one after the other, with a symbol of its own between them, which no run can hold.
    parts, starts, at = [], [], 0
    for k, (first, last) in enumerate(zip(firsts.tolist(), lasts.tolist())):
        parts += [symbols[first:last], np.array([len(known) + k])]
        starts.append(at)
        at += last - first + 1
    shift = firsts - np.array(starts)
    place = np.array(starts)
    runs = periodic_runs(np.concatenate(parts), least_periods, least_length)
    moved = [(s + int(shift[np.searchsorted(place, s, side="right") - 1]), length, p) for s, length, p in runs]
    return sorted(moved, key=lambda run: (run[0], run[2]))


def without_repeats(words: list, runs: list[tuple[int, int, int]]) -> list:
    """Words outside of all runs, and the first period of each run unless it lies in a later period of another."""
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return [w for w, g in zip(words, gone.tolist()) if not g] if runs else words


def document_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
    least_periods: int = 4, least_length: int = 6,
) -> DataFrame:
    """Runs of every whole text and the text with each run cut to its first period.

    Words are what lies between the bytes 0x20 and 0x09-0x0D. ``edit`` may change the words of a row before. One row per
    row, with the columns ``id_col``, ``runs`` (by start, then period; word numbers from 0) and ``collapsed`` (kept words
    joined by one space). NULL and empty texts have no words, no runs and an empty ``collapsed``; equal rows give equal
    rows; rows without an id are kept; other columns, whatever their names, are left out. A text is worked on by
    itself in one task, in time in proportion to its words, so nothing is shuffled and a lost task is just run again.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in buffers.slices(batches, "text"):
            ids = rows.column(0).to_pylist()
            runs, counts, texts = [], [], []
            for row, doc_id in enumerate(ids):
                words = data[offsets[row] : offsets[row + 1]].tobytes().split()
                if edit is not None:
                    words = edit(doc_id, words)
                found = word_runs(words, least_periods, least_length)
                runs += found
                counts.append(len(found))
                texts.append(b" ".join(without_repeats(words, found)).decode())
            flat = np.array(runs, np.int64).reshape(-1, 3)
            entries = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
            at = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.ListArray.from_arrays(at, entries), pa.array(texts, pa.string())], names=[id_col, "runs", "collapsed"]
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(work, f"`{id_col}` {kind}, runs array<{RUN}>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest exact ratio of length to period; ties: smallest start, then smallest period."""

    def order(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return (
            F.when(x > y, -1).when(x < y, 1).when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
            .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0)
        )

    return F.get(F.array_sort(runs, order), 0)
