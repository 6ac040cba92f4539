"""Streams run to the end of the data, checked against the same SQL as their batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures, schemas
from ..session import scratch_folder
from ..sources import sinks
from ..streaming import keeper
from ..streaming import ledger as stream
from .gap_queries import HAS_DOI, NO_ABSTRACT, NO_SECTIONS, WORTH
from .ledger_queries import FOLD_COLUMNS, FOLD_SQL
from .registry import Source, query


def _stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, one file or a folder of them, as a stream of its files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    # Written as a pattern, the path may be a single file.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def _stream_view(spark: SparkSession, sf_dir: str, name: str, streamed: str) -> DataFrame:
    """A derived relation whose ``streamed`` table arrives as a stream."""
    text = fixtures.VIEWS[name]
    used = {t: fixtures.table(spark, sf_dir, t) for t in fixtures.TABLES if "{" + t + "}" in text}
    used[streamed] = _stream_table(spark, sf_dir, streamed)
    return spark.sql(text, **used)


def _ledger_stream(spark: SparkSession, sf_dir: str, root: str, base: DataFrame | None = None) -> str:
    """The ledger after two batches of events that land in two halves out of order; the stream's checkpoint."""
    rows, files = Source(spark, sf_dir).ledger_events, spark.sparkContext.defaultParallelism
    for odd in (1, 0):
        rows.filter(F.col("id") % 2 == odd).repartition(files).write.parquet(f"{root}/events/half={odd}")
    # As many files to a batch as a half has; older ones come first.
    events = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/events")
    # Half of the events are as late as the table is long.
    keeper.start_ledger(events, f"{root}/keeper", base=base, lateness="1000 days", idle_batches=False).awaitTermination()
    return f"{root}/keeper"


@query("stream_ledger_fold", "ledger_events", sql=FOLD_SQL)
def stream_ledger_fold(spark, sf_dir):
    """Odd events first, then the even ones with all resets between: the state equals one fold over all."""
    checkpoint = _ledger_stream(spark, sf_dir, scratch_folder(spark))
    kind = Source(spark, sf_dir).ledger_events.schema["created_at"].dataType.simpleString()
    return keeper.read_ledger(spark, checkpoint, kind).select(FOLD_COLUMNS)


# What the state holds: a cell per column an event has ever set, and every retry after the newest reset.
STATE_SQL = """
WITH r AS (SELECT doi, max(id) AS rid FROM ledger_events WHERE event_type = 'reset' GROUP BY doi),
c AS (SELECT doi, 'downloaded' AS c FROM ledger_events WHERE event_type = 'download'
 UNION SELECT doi, 'download_date' FROM ledger_events WHERE event_type = 'download'
 UNION SELECT doi, status_to || '_downloaded' FROM ledger_events WHERE event_type = 'download' AND status_to IN ('scihub', 'oa')
 UNION SELECT doi, 'download_source' FROM ledger_events WHERE event_type = 'download' AND status_to IN ('scihub', 'oa')
 UNION SELECT doi, event_type || '_status' FROM ledger_events WHERE event_type IN ('pymupdf', 'grobid')
 UNION SELECT doi, event_type || '_date' FROM ledger_events WHERE event_type IN ('pymupdf', 'grobid')
 UNION SELECT doi, 'error_msg' FROM ledger_events WHERE event_type = 'error'),
s AS (SELECT count(*) AS n FROM ledger_events e LEFT JOIN r ON e.doi = r.doi WHERE event_type = 'retry_increment' AND (r.rid IS NULL OR e.id > r.rid))
SELECT (SELECT count(DISTINCT doi) FROM ledger_events) AS dois, (SELECT count(*) FROM c) AS cells, (SELECT n FROM s) AS retries"""


@query("stream_ledger_state", "ledger_events", sql=STATE_SQL)
def stream_ledger_state(spark, sf_dir):
    """Size of the ledger stream's state; steps the watermark has passed are mere counts in it."""
    size = keeper.state_size(spark, _ledger_stream(spark, sf_dir, scratch_folder(spark)))
    return size.select("dois", "cells", (F.col("steps") + F.col("settled")).alias("retries"))


@query(
    "stream_new_work", "papers", "evaluations",
    sql=f"SELECT DISTINCT doi FROM papers WHERE {HAS_DOI} AND ({NO_ABSTRACT} OR {NO_SECTIONS}) AND doi IN ({WORTH})",
)
def stream_new_work(spark, sf_dir):
    root = scratch_folder(spark)
    evaluations = _stream_view(spark, sf_dir, "evaluations", "labels")
    papers = Source(spark, sf_dir).papers
    stream.start_work_list(evaluations, papers, f"{root}/work", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema("doi string").parquet(f"{root}/work")


FINISHED = """SELECT k.doi FROM (SELECT doi FROM tracker UNION SELECT doi FROM ledger_events) k
LEFT JOIN tracker t ON t.doi = k.doi LEFT JOIN (SELECT doi, max(id) AS rid FROM ledger_events WHERE event_type = 'reset' GROUP BY doi) r ON r.doi = k.doi
LEFT JOIN (SELECT doi, max(id) AS gid, arg_max(status_to, id) AS status FROM ledger_events WHERE event_type = 'grobid' GROUP BY doi) g ON g.doi = k.doi
WHERE CASE WHEN g.gid IS NOT NULL AND (r.rid IS NULL OR g.gid > r.rid) THEN g.status WHEN r.rid IS NULL THEN t.grobid_status END = 'success'"""


@query(
    "stream_work_filter", "papers", "tracker", "ledger_events",
    sql=f"SELECT DISTINCT doi FROM papers WHERE {HAS_DOI} AND doi NOT IN ({FINISHED})",
)
def stream_work_filter(spark, sf_dir):
    """Identifiers judged against the ledger's state: a tracker table to begin with, and two runs of events on top."""
    root = scratch_folder(spark)
    checkpoint = _ledger_stream(spark, sf_dir, root, Source(spark, sf_dir).tracker)
    wanted = _stream_view(spark, sf_dir, "papers", "documents").filter("doi <> ''").select("doi")
    stream.start_work_filter(wanted, checkpoint, f"{root}/work", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema("doi string").parquet(f"{root}/work").select("doi").distinct()


# Requests by time in three thirds; a tenth of the first third comes with the last. With a delay of 0.6 of the whole time, those of
# the first 1/15 are late, and no identifier is forgotten before the end.
REQUESTS = """
t AS (SELECT min(created_at) AS t0, max(created_at) AS t1 FROM ledger_events),
q AS (SELECT e.doi, e.id, e.created_at, epoch_us(e.created_at) AS us, epoch_ms(t1) - epoch_ms(t0) AS span,
 (3 * (epoch_ms(e.created_at) - epoch_ms(t0))) // (epoch_ms(t1) - epoch_ms(t0) + 1) AS third FROM ledger_events e, t),
p AS (SELECT *, CASE WHEN third = 0 AND id % 10 = 3 THEN 2 ELSE third END AS part FROM q),
m AS (SELECT part, max(us) AS newest FROM p GROUP BY part),
b AS (SELECT p.doi, coalesce((SELECT max(newest) FROM m WHERE m.part < p.part) - p.us >= 1000 * (6 * p.span // 10), false) AS late FROM p)"""


@query(
    "stream_requests", "ledger_events",
    sql=f"WITH {REQUESTS.strip()} SELECT doi, 1 AS n, false AS late FROM b WHERE NOT late GROUP BY doi UNION ALL SELECT doi, count(*) AS n, true AS late FROM b WHERE late GROUP BY doi",
)
def stream_requests(spark, sf_dir):
    """Requests with repeats and late rows: each identifier once within the watermark, late rows beside them."""
    root = scratch_folder(spark)
    events = Source(spark, sf_dir).ledger_events.select("doi", "id", F.col("created_at").cast("timestamp").alias("created_at"))
    ms = F.unix_millis("created_at")
    m0, m1 = events.agg(F.min(ms), F.max(ms)).first()
    third = F.floor(3 * (ms - F.lit(m0)) / F.lit(m1 - m0 + 1)).cast("int")
    part = F.when((third == 0) & (F.col("id") % 10 == 3), 2).otherwise(third)
    delay = 6 * (m1 - m0) // 10
    for k in range(3):
        events.filter(part == k).select("doi", "created_at").write.parquet(f"{root}/requests/part={k}")
        arriving = spark.readStream.schema("doi string, created_at timestamp").parquet(f"{root}/requests")
        stream.start_routing(arriving, "created_at", delay, f"{root}/routed", f"{root}/routing").awaitTermination()
    # A batch of the second stream is one of the first.
    on_time = spark.readStream.schema("doi string, created_at timestamp").parquet(f"{root}/routed/on_time")
    kept = stream.once_per_key(on_time.select("doi", "created_at"), "doi", "created_at", f"{delay} milliseconds")
    writer = kept.writeStream.format("parquet").option("path", f"{root}/kept").option("checkpointLocation", f"{root}/once")
    writer.trigger(availableNow=True).start().awaitTermination()
    once = spark.read.parquet(f"{root}/kept").groupBy("doi").agg(F.count(F.lit(1)).alias("n")).withColumn("late", F.lit(False))
    late = spark.read.schema("doi string, created_at timestamp").parquet(f"{root}/routed/late")
    return once.unionAll(late.groupBy("doi").agg(F.count(F.lit(1)).alias("n")).withColumn("late", F.lit(True)))


@query(
    "stream_extraction_watch", "extractions", "papers", "tracker",
    sql=f"""SELECT doi, CAST(sum(CASE WHEN doc_id % 5 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS revisions, 'success' AS grobid_status
FROM {fixtures.with_doi('extractions', 'papers', 'tracker')} e WHERE parser = 'grobid' GROUP BY doi""",
)
def stream_extraction_watch(spark, sf_dir):
    """Files that land in two steps, a fifth of them written twice; every revision is one event, and the ledger takes the events."""
    root = scratch_folder(spark)
    s = Source(spark, sf_dir)
    files = s.extractions.select("doc_id", "stem", "parser", F.col("state").alias("body"))
    known = s.papers.select("doi").unionByName(s.tracker.select("doi"))
    for step, some in enumerate((F.col("doc_id") % 3 != 1, (F.col("doc_id") % 3 == 1) | (F.col("doc_id") % 5 == 0))):
        landing = files.filter(some)
        if step:  # of those already there, and of the new ones that count twice, one revision each run
            sinks.write_documents(landing, f"{root}/output", "overwrite")
        else:
            sinks.write_documents(landing, f"{root}/output")
        stream.start_extraction_watch(spark, f"{root}/output", known, f"{root}/events", f"{root}/watch", settle_ms=0).awaitTermination()
    again = files.filter("doc_id % 3 = 1 AND doc_id % 5 = 0")
    sinks.write_documents(again, f"{root}/output", "overwrite")
    stream.start_extraction_watch(spark, f"{root}/output", known, f"{root}/events", f"{root}/watch", settle_ms=0).awaitTermination()
    events = stream.read_events(spark, f"{root}/events")
    keeper.start_ledger(events, f"{root}/keeper").awaitTermination()
    counts = spark.read.schema(schemas.EVENTS).parquet(f"{root}/events").groupBy("doi").agg(F.count(F.lit(1)).alias("revisions"))
    return counts.join(keeper.read_ledger(spark, f"{root}/keeper").select("doi", "grobid_status"), "doi")
