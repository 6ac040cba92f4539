"""Batch extraction that can stop and go on: a stored plan of batches, a job per batch, and a note when it is done."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files, sinks
from .numbering import in_batches

MODES = ("simple", "structured", "full")
RESULT = "stem string, mode string, status string, doi string, error string, body string"
#: Files a plug-in gets at a time; their contents are what a task holds.
FILES_AT_ONCE = 32

#: ``extract(frame, mode)`` takes ``stem`` and ``content`` and returns ``stem`` and ``body`` (JSON text) of the files it could read.
Extractor = Callable[[pd.DataFrame, str], pd.DataFrame]


def plan(pending: DataFrame, out: str, size: int, limit: int | None = None) -> None:
    """Store which files ``(stem, path)`` belong to which batch, in stem order; a plan that is there stays."""
    if sinks.exists(pending.sparkSession, f"{out}/plan/_SUCCESS"):
        return
    # Stored first: rows are numbered in several passes, and the listing of a folder is made once.
    stored = f"{out}/pending"
    pending.select("stem", "path").write.mode("overwrite").parquet(stored)
    rows = pending.sparkSession.read.schema("stem string, path string").parquet(stored)
    rows = rows.orderBy("stem").limit(limit) if limit and limit > 0 else rows
    in_batches(rows, size, "stem").select("stem", "path", "batch").write.partitionBy("batch").mode("overwrite").parquet(f"{out}/plan")


def _read(path: str) -> bytes:
    fs, own = files.opened(path)
    with fs.open_input_file(own) as f:
        return f.read()


def _results(frame: pd.DataFrame, extract: Extractor, mode: str) -> list[tuple]:
    """A result per file. If the plug-in fails on the files together it gets them one by one, so one bad file costs no other."""

    def run(part: pd.DataFrame) -> list[tuple]:
        found = extract(part, mode)
        bodies = dict(zip(found["stem"], found["body"], strict=True))
        rows = []
        for stem in part["stem"]:
            body = bodies.get(stem)
            rows.append((stem, mode, "success" if body else "failed", stem.replace("_", "/"), None, body or None))
        return rows

    try:
        return run(frame)
    except Exception as problem:  # noqa: BLE001 - any plug-in failure is a result
        if len(frame) == 1:
            stem = frame["stem"].iloc[0]
            return [(stem, mode, "error", stem.replace("_", "/"), f"{type(problem).__name__}: {problem}", None)]
        return [row for k in range(len(frame)) for row in _results(frame.iloc[k : k + 1], extract, mode)]


def extracted(pending: DataFrame, extract: Extractor, mode: str = "structured") -> DataFrame:
    """One result row per file ``(stem, path)``: status ``success``, ``failed`` (no body) or ``error``. Tasks open the files."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), FILES_AT_ONCE):
                stems, contents, rows = [], [], []
                for stem, path in zip(frame["stem"][at : at + FILES_AT_ONCE], frame["path"][at : at + FILES_AT_ONCE], strict=True):
                    try:
                        contents.append(_read(path))
                        stems.append(stem)
                    except OSError as problem:
                        rows.append((stem, mode, "error", stem.replace("_", "/"), f"{type(problem).__name__}", None))
                if stems:
                    rows += _results(pd.DataFrame({"stem": stems, "content": contents}), extract, mode)
                yield pd.DataFrame(rows, columns=["stem", "mode", "status", "doi", "error", "body"])

    return pending.select("stem", "path").mapInPandas(work, RESULT)


def run_batches(spark: SparkSession, extract: Extractor, out: str, mode: str = "structured", stop_after: int | None = None) -> bool:
    """Run the batches of the stored plan that are not done yet, in order; true if all are done.

    A batch writes its own folder and is noted when that is complete, so a run that is stopped anywhere goes on with
    the first batch not noted, and a batch that had begun is written anew. ``stop_after`` ends a run after so many.
    """
    todo = sorted(sinks.numbers_in(spark, f"{out}/plan", "batch=") - sinks.numbers_in(spark, f"{out}/_done"))
    for batch in todo[:stop_after]:
        files_of_batch = spark.read.schema("stem string, path string").parquet(f"{out}/plan/batch={batch}")
        spread = files_of_batch.repartition(spark.sparkContext.defaultParallelism)
        extracted(spread, extract, mode).write.mode("overwrite").parquet(f"{out}/results/batch={batch}")
        sinks.noted(spark, f"{out}/_done/{batch}", 1)
    return stop_after is None or len(todo) <= stop_after


def results(spark: SparkSession, out: str) -> DataFrame:
    """Results of the batches that are done."""
    done = sorted(sinks.numbers_in(spark, f"{out}/_done"))
    if not done:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(*[f"{out}/results/batch={b}" for b in done])


def progress(spark: SparkSession, out: str) -> DataFrame:
    """Files of the plan by batch, and whether the batch is done."""
    done = [int(b) for b in sinks.numbers_in(spark, f"{out}/_done")]
    planned = spark.read.schema("stem string, path string, batch bigint").parquet(f"{out}/plan")
    return planned.groupBy("batch").agg(F.count(F.lit(1)).alias("files")).withColumn("done", F.col("batch").isin(done) if done else F.lit(False))
