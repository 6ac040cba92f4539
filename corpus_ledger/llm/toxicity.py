"""Toxicity: a linear classifier over character n-grams whose features are scaled by naive Bayes log-count ratios.

A feature is whether a hashed n-gram is in the text. Its scale is the log of how much larger its
smoothed share among toxic training texts is than among the others. A logistic regression over the
scaled features is fitted to at most ``MOST_PER_CLASS`` labelled texts of each class, with toxic
texts weighing ``TOXIC_WEIGHT`` together. It sees the ``FEATURES`` n-grams that set toxic
texts apart most, chosen on the same texts. N-grams that are usual in clean texts are left out:
a long text has nearly all of them, and they would outvote what is toxic in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import buffers, chargrams
from .tables import opened, shared

SIZES = (4, 5)
CELLS = 1 << 20
#: Bounds of the fit: labelled texts of each class (the first by a hash of their id), and features.
MOST_PER_CLASS = 8000
FEATURES = 4096
SMOOTH = 1.0
TOXIC_WEIGHT = 0.3
RIDGE = 1e-4
ROUNDS = 300


def held_out() -> Column:
    """Rows no label is learned from: CRC-32 of the id as text divides by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def usable(labels: DataFrame) -> DataFrame:
    """``doc_id``, ``toxic`` of the rows to learn from; an id with both labels counts as toxic."""
    rows = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out())
    return rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def training_ids(by_id: DataFrame, most: int = MOST_PER_CLASS) -> DataFrame:
    """At most ``most`` rows of each class, those first by a hash of the id."""
    pick = [by_id.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for t in (0, 1)]
    return pick[0].unionByName(pick[1])


@buffers.lean
def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each class have a cell, and (cell -1) how many texts there are."""
    counts = np.zeros((2, CELLS), np.int32)
    texts = np.zeros(2, np.int64)
    for batch, data, offsets in buffers.slices(batches, "text"):
        toxic = np.asarray(batch.column(batch.schema.get_field_index("toxic")))
        text, cell = chargrams.grams(*chargrams.code_points(data, offsets), SIZES, CELLS)
        pair = np.unique(text * CELLS + cell)
        for t in (0, 1):
            counts[t] += np.bincount(pair[toxic[pair // CELLS] == t] & (CELLS - 1), minlength=CELLS).astype(np.int32)
            texts[t] += (toxic == t).sum()
    some = np.flatnonzero(counts.any(0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(some, -1)), pa.array(np.append(counts[0][some], texts[0]), pa.int64()), pa.array(np.append(counts[1][some], texts[1]), pa.int64())],
        names=["cell", "clean", "toxic"],
    )


class Classifier:
    """Weights of the chosen cells (scale times coefficient) and the intercept."""

    def __init__(self, cells: np.ndarray, weights: np.ndarray, intercept: float):
        self.cells, self.weights, self.intercept = cells, weights, intercept

    def scores(self, data: np.ndarray, offsets: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        keep, weight = table
        text, cell = chargrams.grams(*chargrams.code_points(data, offsets), SIZES, CELLS, keep)
        pair = np.unique(text * CELLS + cell)
        total = np.bincount(pair // CELLS, weights=weight[pair & (CELLS - 1)], minlength=len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(total + self.intercept, -500, 500)))

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        keep, weight = np.zeros(CELLS, bool), np.zeros(CELLS)
        keep[self.cells], weight[self.cells] = True, self.weights
        return keep, weight


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Learn from the labelled rows of ``docs``; without rows of both classes every score is next to 0, or to 1 if all labels are toxic."""
    # The bound is spent on ids that are there: labels may cover other documents too.
    by_id = usable(labels).join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    sample = F.broadcast(training_ids(by_id))  # at most two times MOST_PER_CLASS narrow rows
    rows = docs.select("doc_id", "text").join(sample, "doc_id").select("text", "toxic")
    cells = rows.mapInArrow(_presence, "cell bigint, clean bigint, toxic bigint").groupBy("cell").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    n = cells.filter("cell = -1").first()
    if n is None or not n["clean"] or not n["toxic"]:
        share = 0.0 if n is None or not n["toxic"] else 1.0
        return Classifier(np.zeros(0, np.int64), np.zeros(0), 500.0 if share else -500.0)
    p, q = (F.col("toxic") + SMOOTH) / (n["toxic"] + 2 * SMOOTH), (F.col("clean") + SMOOTH) / (n["clean"] + 2 * SMOOTH)
    ratio = F.log(p / q)
    apart = (F.col("toxic") / n["toxic"] - F.col("clean") / n["clean"]) * ratio
    best = (
        cells.filter("cell >= 0 AND toxic >= 3").select("cell", ratio.alias("ratio"), apart.alias("apart")).filter("ratio > 0").orderBy(F.desc("apart"), "cell").limit(FEATURES).collect()
    )
    chosen = np.array(sorted(r["cell"] for r in best), np.int64)
    scale = np.array([r["ratio"] for r in sorted(best, key=lambda r: r["cell"])])
    index = np.full(CELLS, -1, np.int32)
    index[chosen] = np.arange(len(chosen))

    @buffers.lean
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in buffers.slices(batches, "text"):
            text, cell = chargrams.grams(*chargrams.code_points(data, offsets), SIZES, CELLS, index >= 0)
            pair = np.unique(text * CELLS + cell)
            counts = np.bincount(pair // CELLS, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("toxic")), buffers.lists(index[pair & (CELLS - 1)], counts, pa.int32())], names=["toxic", "features"]
            )

    got = rows.mapInArrow(features, "toxic int, features array<int>").toArrow()
    y = np.asarray(got.column("toxic").combine_chunks()).astype(np.float64)
    lists = got.column("features").combine_chunks()
    sizes = np.asarray(lists.value_lengths()).astype(np.int64)
    weights, intercept = logistic(np.repeat(np.arange(len(y)), sizes), np.asarray(lists.flatten()).astype(np.int64), scale, y, TOXIC_WEIGHT)
    return Classifier(chosen, weights * scale, intercept)


def logistic(row: np.ndarray, column: np.ndarray, scale: np.ndarray, y: np.ndarray, weight: float) -> tuple[np.ndarray, float]:
    """Ridge logistic regression over scaled presence features by accelerated gradient steps.

    Rows of label 1 together weigh ``weight``. The order of rows does not matter beyond rounding.
    """
    n, value = len(y), scale[column]
    share = np.where(y == 1, weight / max(1, (y == 1).sum()), (1 - weight) / max(1, (y == 0).sum()))
    # The step follows the largest curvature of the loss, by power iteration.
    v = np.ones(len(scale) + 1)
    for _ in range(20):
        z = np.bincount(row, weights=value * v[column], minlength=n) + v[-1]
        v = np.append(np.bincount(column, weights=value * (share * z)[row], minlength=len(scale)), (share * z).sum())
        curve = np.linalg.norm(v)
        v /= curve or 1.0
    step = 1 / (curve / 4 + RIDGE)
    w = old = np.zeros(len(scale) + 1)
    for k in range(ROUNDS):
        ahead = w + (k / (k + 3)) * (w - old)
        z = np.bincount(row, weights=value * ahead[column], minlength=n) + ahead[-1]
        off = share * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
        slope = np.append(np.bincount(column, weights=value * off[row], minlength=len(scale)) + RIDGE * ahead[:-1], off.sum())
        w, old = ahead - step * slope, w
    return w[:-1], float(w[-1])


def scored(docs: DataFrame, classifier: Classifier, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``score`` for each row of ``docs``: how likely label 1 is, 0 to 1.

    NULL and empty texts, and texts shorter than the n-grams, get the score of a text without
    features. Repeated rows each come out.
    """
    handle = shared(docs.sparkSession, classifier)

    @buffers.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = opened(Classifier, handle)
        table = own.table()
        for batch, data, offsets in buffers.slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.scores(data, offsets, table))], names=["doc_id", "score"])

    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for each row of ``docs``."""
    return scored(docs, fit(docs, labels)).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """Rows of ``docs`` with a score below 0.5, as they are; a NULL or empty text has the score of a text without features."""
    handle = shared(docs.sparkSession, classifier)

    @buffers.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = opened(Classifier, handle)
        table = own.table()
        for batch, data, offsets in buffers.slices(batches, "text"):
            yield batch.filter(pa.array(own.scores(data, offsets, table) < 0.5))

    return docs.mapInArrow(run, docs.schema)
