"""Texts of an Arrow batch as byte buffers: slices, words, and hashes of words and byte runs.

The functions here work on one slice of a batch, a few MB of text, inside a Python task.
``offsets`` has one more entry than there are texts; text ``i`` is ``data[offsets[i]:offsets[i+1]]``.
Hashes are 64 bits wide and depend on content only, so they agree between tasks and runs.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20


def lean(run):
    """Batches of a task, and then back to the machine what memory the task held.

    A Python worker serves one task after another, and keeps what its allocators have once had.
    """

    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
        if trim is not None:
            trim(0)

    return wrapped


U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1  # odd, so that its powers have inverses modulo 2**64
WHITE = bytes([0x20, *range(0x09, 0x0E)])


def separators(white: bytes = WHITE) -> np.ndarray:
    """Lookup table: is this byte outside of words?"""
    table = np.zeros(256, bool)
    table[list(white)] = True
    return table


def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


def column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; NULL counts as empty."""
    arr = batch.column(batch.schema.get_field_index(name))
    wide = pa.large_string() if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else pa.large_binary()
    arr = arr.cast(wide)
    if arr.null_count:
        arr = arr.fill_null("" if wide == pa.large_string() else b"")
    n = len(arr)
    offsets = np.frombuffer(arr.buffers()[1], np.int64, n + 1 + arr.offset)[arr.offset :] if n else np.zeros(1, np.int64)
    body = arr.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], name: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of whole rows with at most ``most`` text bytes each; a longer text is a run by itself."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = column(batch, name)
        at, n = 0, batch.num_rows
        while at < n:
            end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
            end = min(max(end, at + 1), n)
            yield batch.slice(at, end - at), data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
            at = end


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def _codes(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(BASE) + U64(seed))


class _Powers(dict):
    """Tables kept per process; a copy sent to a task starts empty."""

    def __reduce__(self):
        return _Powers, ()


POWERS = _Powers()


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, grown by doubling."""
    have = POWERS.get(base)
    if have is None:
        have = np.array([1], U64)
    while len(have) < n:
        have = np.concatenate([have, have * U64(pow(base, len(have), 1 << 64))])
    if len(have) <= 1 << 23:
        POWERS[base] = have
    return have[:n]


INVERSE = pow(BASE, -1, 1 << 64)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run ``values[start:end]`` of 64-bit codes: a polynomial read off running sums."""
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values * powers(len(values)), out=total[1:])
    raw = (total[ends] - total[starts]) * powers(len(values) + 1, INVERSE)[starts]
    return mix(raw + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def byte_codes(data: np.ndarray, seed: int = 1) -> np.ndarray:
    return _codes(seed)[data]


def word_spans(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the place of each text's first word (one entry more than texts)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~outside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside & edge[:-1]
    first[1:] |= inside[1:] & ~inside[:-1]
    last = inside & edge[1:]
    last[:-1] |= inside[:-1] & ~inside[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    return run_hashes(byte_codes(data, seed), starts, ends) if len(starts) else np.zeros(0, U64)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words, whatever text they are of."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    h = np.zeros(n, U64)
    for j in range(size):
        h += words[j : j + n] * U64(pow(BASE, j + 1, 1 << 64))
    return mix(h)


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return h.view(np.int64)


def places(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. within each run of the given lengths."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    return np.arange(total, dtype=np.int64) - np.repeat(np.cumsum(counts) - counts, counts)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and list lengths."""
    at = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values, kind))


class Kept:
    """Runs of 32-bit values by 64-bit keys in sorted arrays: a dictionary of arrays would take ten times the memory."""

    def __init__(self):
        self.keys, self.flat = np.zeros(0, U64), np.zeros(0, np.int32)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def __len__(self) -> int:
        return len(self.keys)

    @property
    def nbytes(self) -> int:
        return self.keys.nbytes + self.flat.nbytes + self.begin.nbytes + self.size.nbytes

    def runs(self, keys: np.ndarray, make, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A table of values, and where each key's run begins in it and how long it is.

        ``keys`` are sorted and differ. ``make`` gives sizes and values of the runs of the keys (by place) that are not held yet; those
        that are marked in ``keep`` are held from then on.
        """
        at = np.searchsorted(self.keys, keys)
        have = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        have[inside] = self.keys[at[inside]] == keys[inside]
        begin, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        begin[have], size[have] = self.begin[at[have]], self.size[at[have]]
        new = np.flatnonzero(~have)
        if len(new):
            sizes, values = make(new)
            size[new], begin[new] = sizes, len(self.flat) + np.cumsum(sizes) - sizes
            self.flat = np.concatenate([self.flat, values])
            new = new[keep[new]]
            self.keys = np.insert(self.keys, at[new], keys[new])
            self.begin = np.insert(self.begin, at[new], begin[new])
            self.size = np.insert(self.size, at[new], size[new])
        return self.flat, begin, size


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values, by doubling the width."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    got, have = values, 1
    while have * 2 <= width:
        got = np.minimum(got[:-have], got[have:])
        have *= 2
    return np.minimum(got[:n], got[width - have : width - have + n])
