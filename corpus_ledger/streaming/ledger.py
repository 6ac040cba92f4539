"""Streams around the ledger: events, rewritten files, new evaluations, identifiers.

The ledger itself is the state of one stream (:mod:`keeper`). Other streams hand it events, or read it as of a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions.identifiers import FAST_SUFFIX
from ..functions.text import is_value
from ..operators import gaps
from ..operators.inventory import with_doi
from ..sources import files, sinks
from . import keeper


def read_events(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.EVENTS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def _start(stream: DataFrame, apply, checkpoint: str, interval: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def extraction_revisions(spark: SparkSession, folder: str, settle_ms: int = 1000) -> DataFrame:
    """Stream of structured outputs by file stem: a row each time a file is written, with its time."""
    found = files.file_revisions(spark, folder, "*.json", settle_ms)
    stem = F.regexp_replace("name", r"(?i)\.json$", "")
    return found.filter(~stem.endswith(FAST_SUFFIX)).select(stem.alias("stem"), "length", F.col("modificationTime").alias("seen"))


#: What a new structured output says about its paper.
PARSED = {"downloaded": schemas.YES, "scihub_available": schemas.YES, "grobid_status": schemas.SUCCESS}


def extraction_events(revisions: DataFrame, known: DataFrame) -> DataFrame:
    """One ledger event per revision: the paper is parsed as of the time of the file. ``known`` has DOIs to tell stems by."""
    changes = F.create_map(*[F.lit(x) for pair in PARSED.items() for x in pair])
    number = F.xxhash64("stem", "seen").bitwiseAND(F.lit((1 << 63) - 1))
    return with_doi(revisions, known).select(
        number.alias("id"), "doi", F.lit("update").alias("event_type"), F.lit(None).cast("string").alias("status_from"),
        F.lit(None).cast("string").alias("status_to"), F.lit(None).cast("string").alias("message"), F.col("seen").alias("created_at"),
        changes.alias("changes"),
    )


def start_extraction_watch(
    spark: SparkSession, folder: str, known: DataFrame, events: str, checkpoint: str, interval: str | None = None, settle_ms: int = 1000,
) -> StreamingQuery:
    """Append an event to the event table whenever a structured output is written or rewritten, each revision once.

    The events of a batch are a folder of their own, and an event's id comes from file and time, so a batch that
    runs again gives the same events. The ledger's own stream reads them like any others.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        extraction_events(batch, known).write.mode("overwrite").parquet(f"{events}/watch={batch_id}")

    return _start(extraction_revisions(spark, folder, settle_ms), apply, checkpoint, interval)


def read_new_evaluations(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(schemas.EVALUATIONS).parquet(folder)


def once_per_key(rows: DataFrame, key: str, stamp: str | None = None, delay: str | None = None) -> DataFrame:
    """The first row of each key. With a time column, a key is forgotten when the watermark is ``delay`` beyond it."""
    if stamp is None:
        return rows.dropDuplicates([key])
    return rows.withWatermark(stamp, delay).dropDuplicatesWithinWatermark([key])


def new_work(evaluations: DataFrame, papers: DataFrame, stamp: str | None = None, delay: str | None = None) -> DataFrame:
    """DOIs to work on as their evaluations arrive.

    Each comes once. Without a time column the state has one entry per accepted DOI, for ever; with one, a DOI
    that is evaluated again later than ``delay`` may come again, and the state holds the DOIs of that time only.
    """
    result, confidence = F.col("result"), F.coalesce(F.col("confidence_score"), F.lit(gaps.NO_CONFIDENCE))
    accepted = evaluations.filter(
        (F.col("doi") != "")
        & (result.isin(*gaps.ACCEPTED) | ((result == gaps.REJECTED) & (confidence <= gaps.MAX_REJECT_CONFIDENCE)))
    ).select("doi", *([stamp] if stamp else []))
    needed = gaps.keyed(papers).filter(gaps.missing_abstract_or_sections()).select("doi").distinct()
    return once_per_key(accepted, "doi", stamp, delay).join(needed, "doi", "left_semi")


def start_work_list(
    evaluations: DataFrame, papers: DataFrame, out: str, checkpoint: str, stamp: str | None = None, delay: str | None = None,
) -> StreamingQuery:
    """Append new work to a list (exactly-once file sink)."""
    return (
        new_work(evaluations, papers, stamp, delay)
        .select("doi")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def start_routing(rows: DataFrame, stamp: str, delay_ms: int, out: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Split a stream in ``out/on_time`` and ``out/late``, in folders by batch.

    A row is late if it is ``delay_ms`` or more older than the newest row of the batches before, or has no time. The newest time
    of each batch is noted in ``out/marks``, so a batch that runs again splits its rows the same way. A watermark
    with that delay over ``on_time`` drops nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        border = _newest_mark(batch.sparkSession, f"{out}/marks", batch_id)
        age = F.timestamp_diff("MILLISECOND", F.col(stamp), F.lit(border).cast(batch.schema[stamp].dataType))
        late = F.col(stamp).isNull() | (F.coalesce(age, F.lit(-1)) >= delay_ms)
        held.filter(~late).write.mode("overwrite").parquet(f"{out}/on_time/batch={batch_id}")
        held.filter(late).write.mode("overwrite").parquet(f"{out}/late/batch={batch_id}")
        held.agg(F.max(stamp).cast("string").alias("newest")).write.mode("overwrite").parquet(f"{out}/marks/batch={batch_id}")
        held.unpersist()

    return _start(rows, apply, checkpoint, interval)


def _newest_mark(spark: SparkSession, marks: str, below: int) -> str | None:
    """Newest time of the batches before, as text; the noted marks are one value per batch."""
    if below == 0:
        return None
    return spark.read.schema("newest string, batch bigint").parquet(marks).filter(F.col("batch") < below).agg(F.max("newest")).first()[0]


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the query of a checkpoint; a new checkpoint is a new query."""
    return spark.read.text(f"{checkpoint}/metadata", wholetext=True).select(F.get_json_object("value", "$.id")).first()[0]


def start_work_filter(
    identifiers: DataFrame, ledger_checkpoint: str, out: str, checkpoint: str, parser: str = "grobid", stamp: str | None = None, delay: str | None = None,
) -> StreamingQuery:
    """Pass on identifiers a parser has not finished yet.

    A batch is judged against the ledger as of its newest batch when it first runs. That batch is noted beside the output, so a batch
    that is run again gives the same list as long as the state store keeps the noted version (Spark's
    ``minBatchesToRetain``, 100 by default; a version that is gone raises). With a time column, an identifier that comes
    again within ``delay`` is passed on once.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        wanted = batch.select("doi").distinct()
        note = f"{out}/_judged/{_query_id(session, checkpoint)}/{batch_id}"
        version = sinks.noted(session, note, keeper.newest_batch(session, ledger_checkpoint))
        if version >= 0:
            held = keeper.read_ledger(session, ledger_checkpoint, batch_id=version)
            done = held.filter(is_value(F.col(f"{parser}_status"), schemas.SUCCESS)).select("doi")
            wanted = wanted.join(done, "doi", "left_anti")
        sinks.write_snapshot(wanted, out, batch_id)

    rows = identifiers if stamp is None else once_per_key(identifiers, "doi", stamp, delay)
    return _start(rows, apply, checkpoint, None)
