"""Character n-grams of texts, hashed to cells of a fixed table."""

from __future__ import annotations

import numpy as np

from . import buffers


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts with A-Z lowered, and where each text begins among them."""
    body = buffers.lower_ascii()[data]
    try:
        points = np.frombuffer(body.tobytes().decode().encode("utf-32-le"), "<u4")
        begins = np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80)])
        return points, begins[offsets]
    except UnicodeDecodeError:  # text by text, what is not UTF-8 replaced
        raw = body.tobytes()
        parts = [raw[a:b].decode(errors="replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        points = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")
        return points, np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def gram_cells(points: np.ndarray, size: int, cells: int) -> np.ndarray:
    """Cell of the ``size`` characters from each position on, whatever text they are of; ``cells`` is a power of two."""
    n = len(points) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.full(n, size, np.uint32)
    for j in range(size):
        h = h * np.uint32(0x01000193) ^ points[j : j + n] * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return (h & np.uint32(cells - 1)).astype(np.int64)


def grams(points: np.ndarray, at: np.ndarray, sizes: tuple[int, ...], cells: int, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Text and cell of every n-gram that lies within one text; with ``keep``, only of the cells marked there."""
    texts, found = [], []
    lengths = np.diff(at)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    left = np.repeat(at[1:], lengths) - np.arange(len(points))
    for size in sizes:
        cell = gram_cells(points, size, cells)
        fit = left[: len(cell)] >= size
        if keep is not None:
            fit &= keep[cell]
        where = np.flatnonzero(fit)
        texts.append(owner[where])
        found.append(cell[where])
    return np.concatenate(texts), np.concatenate(found)
