"""Language ID: nearest of several centroids per language, by cosine of TF-IDF vectors of character n-grams.

Document frequencies are counted over all training rows. The centroids of a language are found by
spherical k-means on at most about ``MOST_PER_LANGUAGE`` of its rows, in one task per language.
A text farther from its nearest centroid than nearly all rows of that language is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import buffers, chargrams
from .tables import opened, shared, written

SIZES = (1, 2, 3)
CELLS = 1 << 12
#: Bound of the k-means sample of each language: rows whose hash falls below the share that gives so many.
MOST_PER_LANGUAGE = 600
MOST_LANGUAGES = 4096
CENTROIDS = 3
ROUNDS = 12
#: Texts per matrix, and the share of a language's sample that lies beyond its rejection distance.
ROWS = 256
TAIL = 0.005
UNKNOWN = "und"


def held_out() -> Column:
    """Rows nothing is learned from: CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """N-gram counts of each text, one row each."""
    n = len(offsets) - 1
    text, cell = chargrams.grams(*chargrams.code_points(data, offsets), SIZES, CELLS)
    return np.bincount(text * CELLS + cell, minlength=n * CELLS).reshape(n, CELLS)


def vectors(table: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF with dampened counts, each row of length 1 (or 0 without n-grams)."""
    v = np.log1p(table.astype(np.float32)) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _pieces(batches: Iterator[pa.RecordBatch], name: str = "text"):
    """Slices of at most ROWS texts."""
    for batch, data, offsets in buffers.slices(batches, name):
        for a in range(0, batch.num_rows, ROWS):
            b = min(a + ROWS, batch.num_rows)
            yield batch.slice(a, b - a), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, texts = np.zeros(CELLS, np.int64), 0
    for batch, data, offsets in _pieces(batches):
        total += (counts(data, offsets) > 0).sum(0)
        texts += batch.num_rows
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], texts))], names=["cell", "n"])


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Is there a letter of any script in each text?"""
    lower = buffers.lower_ascii()[data]
    ascii_letters = np.concatenate([[0], np.cumsum((lower >= 0x61) & (lower <= 0x7A))])
    found = np.diff(ascii_letters[offsets]) > 0
    for k in np.flatnonzero(~found).tolist():
        body = data[offsets[k] : offsets[k + 1]]
        if (body >= 0x80).any():
            found[k] = any(c.isalpha() for c in body.tobytes().decode(errors="replace"))
    return found


def kmeans(points: np.ndarray, k: int) -> np.ndarray:
    """Centres on the unit sphere. The first is the point nearest to the mean, the next ones are the farthest from those before."""
    mean = points.sum(0)
    centres = [points[np.argmax(points @ mean)]]
    while len(centres) < min(k, len(points)):
        nearest = (points @ np.array(centres).T).max(1)
        centres.append(points[np.argmin(nearest)])
    c = np.array(centres)
    for _ in range(ROUNDS):
        own = (points @ c.T).argmax(1)
        sums = np.array([points[own == j].sum(0) if (own == j).any() else c[j] for j in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c.astype(np.float32)


class Model:
    def __init__(self, idf: np.ndarray, languages: list[str], centres: np.ndarray, limits: np.ndarray):
        self.idf, self.languages, self.centres, self.limits = idf, languages, centres, limits


def fit(docs: DataFrame) -> Model | None:
    """Learn from text and language of the rows that are not held out; None if there are none."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    # Only languages of more rows than are wanted need thinning; a language past the bound keeps all its few rows.
    large = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > MOST_PER_LANGUAGE).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)
    frequency = {r["cell"]: r["n"] for r in rows.select("text").mapInArrow(_document_frequency, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    texts = frequency.pop(-1, 0)
    if not texts:
        return None
    df = np.zeros(CELLS)
    df[list(frequency)] = list(frequency.values())
    idf = np.log((1 + texts) / (1 + df)).astype(np.float32) + np.float32(0.1)
    # A row's place in the hash range decides, so a language of n rows gives MOST_PER_LANGUAGE on average.
    place = F.xxhash64("doc_id", "text") / F.lit(float(1 << 63))
    share = F.coalesce(2.0 * MOST_PER_LANGUAGE / F.col("n") - 1.0, F.lit(2.0))
    sample = rows.join(F.broadcast(large), "lang", "left").filter(place < share).select("lang", "text")

    def vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in _pieces(batches):
            v = vectors(counts(data, offsets), idf).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in v], pa.binary())], names=["lang", "vector"])

    def cluster(key, rows):  # no type hints: postponed ones are not understood here
        points = np.array([np.frombuffer(b, np.float16) for b in rows.column("vector").to_pylist()]).astype(np.float32)
        points = points[np.lexsort(points[:, :8].T)]
        c = kmeans(points, CENTROIDS)
        limit = float(np.quantile((points @ c.T).max(1), TAIL))
        return pa.table({"lang": [key[0].as_py()] * len(c), "centre": pa.array([x.tobytes() for x in c], pa.binary()), "at_least": [limit] * len(c)})

    points = written(sample.mapInArrow(vector, "lang string, vector binary"), "vectors")
    centres = points.groupBy("lang").applyInArrow(cluster, "lang string, centre binary, at_least double").collect()
    centres.sort(key=lambda r: (r["lang"], r["centre"]))
    matrix = np.array([np.frombuffer(r["centre"], np.float32) for r in centres])
    return Model(idf, [r["lang"] for r in centres], matrix, np.array([r["at_least"] for r in centres]))


def identified(docs: DataFrame, model: Model | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (cosine to the nearest centroid, 0 to 1), ``rejected`` for each row of ``docs``.

    A NULL text, or one without a letter, is ``und`` with score 0 and rejected, and so is every
    text if there was nothing to learn from. A rejected text keeps its nearest language. Ties go
    to the language first in order. Repeated rows each come out.
    """
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    handle = shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = opened(Model, handle)
        for batch, data, offsets in _pieces(batches):
            n = batch.num_rows
            known = has_letter(data, offsets) if m is not None and len(m.languages) else np.zeros(n, bool)
            name, score, rejected = np.full(n, UNKNOWN, object), np.zeros(n), np.ones(n, bool)
            if known.any():
                near = vectors(counts(data, offsets), m.idf) @ m.centres.T
                best = near.argmax(1)
                score = np.where(known, np.clip(near[np.arange(n), best], 0, 1), 0.0).astype(np.float64)
                rejected = ~known | (score < m.limits[best])
                name[known] = np.array(m.languages, object)[best[known]]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(name, pa.string()), pa.array(score), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "rejected"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def language_report(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``rejected`` for each row of ``docs``."""
    return identified(docs, fit(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
