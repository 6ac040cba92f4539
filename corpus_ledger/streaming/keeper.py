"""The ledger as keyed state of a stream: one summary per DOI in Spark's state store.

A summary holds, per column, the newest setting with its stamp; the newest reset; and the retries since the newest event
that set their count. Two summaries merge to one whatever the order they come in, so events may arrive late or in any
order, tasks combine their events of a DOI before the shuffle, and a batch touches only the DOIs of its events. The state
of a DOI is as large as its set columns and the steps (retry increments) that a late reset could still take back; a timer
turns steps older than the allowed lateness into a count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .. import schemas
from ..operators import ledger
from ..sources import sinks

#: The state of one DOI. Stamps are (microseconds, event id); an event without a time is before all others.
SUMMARY = (
    "cells array<struct<name:string,v:string,at:bigint,id:bigint>>, steps array<struct<at:bigint,id:bigint>>, settled bigint, settled_at bigint, "
    "reset_at bigint, reset_id bigint, base_at bigint, base_id bigint, base int, seen bigint"
)
FIELDS = ("cells", "steps", "settled", "settled_at", "reset_at", "reset_id", "base_at", "base_id", "base", "seen")
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
VARIABLE = "ledger"
LATENESS = "7 days"
BEFORE_ALL = -(1 << 63)
#: Summaries a task holds at a time to merge them; any number gives the same state.
HELD = 100_000


# -- events to summaries and back --------------------------------------------------------


def _micros(stamp: Column, kind: str) -> Column:
    """Microseconds since 1970 on the stamp's own scale; BEFORE_ALL for none."""
    start = F.lit("1970-01-01 00:00:00").cast(kind)
    return F.coalesce(F.timestamp_diff("MICROSECOND", start, stamp), F.lit(BEFORE_ALL))


def _stamp(micros: Column, kind: str) -> Column:
    start = F.lit("1970-01-01 00:00:00").cast(kind)
    return F.when(micros != BEFORE_ALL, F.timestamp_add("MICROSECOND", micros, start)).cast(kind)


def event_summaries(events: DataFrame) -> DataFrame:
    """One summary per event: what it sets, and whether it resets or adds a retry. Events without a DOI are left out."""
    events = ledger._with_optional(events)
    kind = events.schema["created_at"].dataType.simpleString()
    at, number, is_reset = _micros(F.col("created_at"), kind), F.col("id").cast("bigint"), F.col("event_type") == "reset"

    def cell(column: str, setting: Column) -> Column:
        value = _micros(setting["v"], kind) if column in schemas.DATE_COLUMNS else setting["v"]
        text = F.when(setting["v"].isNotNull(), value.cast("string"))
        return F.when(setting.isNotNull(), F.struct(F.lit(column).alias("name"), text.alias("v"), at.alias("at"), number.alias("id")))

    cells = F.array_compact(F.array(*[cell(c, s) for c, s in ledger.event_settings(kind).items()]))
    sets_retries = F.coalesce(F.map_contains_key("changes", F.lit("retry_count")), F.lit(False))
    is_base = is_reset | sets_retries
    base = F.when(is_reset, 0).otherwise(F.coalesce(F.try_element_at("changes", F.lit("retry_count")).try_cast("int"), F.lit(0)))
    step = F.when(F.col("event_type") == "retry_increment", F.array(F.struct(at.alias("at"), number.alias("id"))))
    return events.filter(F.col("doi").isNotNull()).select(
        "doi", cells.alias("cells"), F.coalesce(step, F.array().cast("array<struct<at:bigint,id:bigint>>")).alias("steps"),
        F.lit(0).cast("bigint").alias("settled"), F.lit(BEFORE_ALL).cast("bigint").alias("settled_at"),
        F.when(is_reset, at).alias("reset_at"), F.when(is_reset, number).alias("reset_id"),
        F.when(is_base, at).alias("base_at"), F.when(is_base, number).alias("base_id"), F.when(is_base, base).alias("base"), at.alias("seen"),
    )


def as_set_events(base: DataFrame) -> DataFrame:
    """A ledger as update events without a time, so older than any other. Only set columns are carried."""
    names = [*schemas.TRACKER_COLUMNS, "retry_count"]
    pairs = F.filter(
        F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v")) for c in names]), lambda p: p["v"].isNotNull()
    )
    return base.select(
        F.lit(-1).cast("bigint").alias("id"), "doi", F.lit("update").alias("event_type"),
        *[F.lit(None).cast("string").alias(c) for c in ("status_from", "status_to", "message")], F.map_from_entries(pairs).alias("changes"),
    )


def ledger_of(summaries: DataFrame, date_type: str = "timestamp") -> DataFrame:
    """Ledger rows of summaries: columns set after the newest reset, and the retries since their last setting."""
    after = lambda c: F.col("reset_at").isNull() | (F.struct(c["at"], c["id"]) > F.struct("reset_at", "reset_id"))
    alive = F.transform(F.filter("cells", after), lambda c: F.struct(c["name"], c["v"]))
    rows = summaries.withColumn("alive", F.map_from_entries(alive))

    def column(name: str) -> Column:
        value = F.try_element_at("alive", F.lit(name))
        return _stamp(value.cast("bigint"), date_type).alias(name) if name in schemas.DATE_COLUMNS else value.alias(name)

    retries = F.coalesce("base", F.lit(0)) + F.col("settled") + F.size("steps")
    return rows.select(
        "doi", *[column(c) for c in schemas.TRACKER_COLUMNS], _stamp(F.col("seen"), date_type).alias("last_updated"), retries.cast("int").alias("retry_count")
    )


# -- merging -----------------------------------------------------------------------------


def _newest(a: tuple, b: tuple) -> tuple:
    """Of two (at, id, ..) the later one; one without a time is none."""
    if b[0] is None:
        return a
    return b if a[0] is None or b[:2] > a[:2] else a


def merged(*parts: tuple) -> tuple:
    """The summary of several summaries (values in the order of ``FIELDS``)."""
    cells: dict[str, tuple] = {}
    for p in parts:
        for c in p[0]:
            have = cells.get(c[0])
            if have is None or c[2:] > have[2:]:
                cells[c[0]] = c
    reset = reduce(_newest, [p[4:6] for p in parts])
    base = reduce(_newest, [p[6:9] for p in parts])
    steps = [s for p in parts for s in p[1] if base[0] is None or s > base[:2]]
    # Counted steps are after the base unless it is newer than the newest of them.
    settled = [p for p in parts if p[2] and (base[0] is None or base[0] <= p[3])]
    settled_at = max([p[3] for p in settled], default=BEFORE_ALL)
    return (list(cells.values()), steps, sum(p[2] for p in settled), settled_at, *reset, *base, max(p[9] for p in parts))


def settled_before(summary: tuple, horizon: int) -> tuple:
    """Steps up to a time as a mere count."""
    s = dict(zip(FIELDS, summary))
    old = [step for step in s["steps"] if step[0] <= horizon]
    s["steps"] = [step for step in s["steps"] if step[0] > horizon]
    s["settled"] += len(old)
    s["settled_at"] = max([s["settled_at"], *(step[0] for step in old)])
    return tuple(s[f] for f in FIELDS)


def _plain(row) -> tuple:
    """A summary as tuples only (the state store takes no rows within), from a row or a plain tuple of Spark's."""
    cells, steps, *rest = [row[f] for f in FIELDS] if hasattr(row, "__fields__") else row
    tuples = lambda items: [tuple(i.values()) if isinstance(i, dict) else tuple(i) for i in items or []]
    return (tuples(cells), tuples(steps), *rest)


def _lists(kind: pa.DataType, items: pa.Array, owner: np.ndarray, n: int) -> pa.ListArray:
    """A list for each of ``n`` owners, from items in the order of their owners."""
    at = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), items, type=kind)


def merged_rows(rows: pa.Table) -> pa.RecordBatch:
    """``merged`` over all rows of each DOI at once, one row for each DOI."""
    rows = rows.combine_chunks().to_batches()[0]
    column = lambda name: rows.column(rows.schema.get_field_index(name))
    longs = lambda values: np.asarray(values.fill_null(0), np.int64)
    keys = column("doi").dictionary_encode()
    owner, n = np.asarray(keys.indices, np.int64), len(keys.dictionary)

    def newest(at: str, number: str) -> np.ndarray:
        """Row of each DOI's greatest stamp, the first of equal ones; -1 if it has none."""
        some = np.flatnonzero(np.asarray(column(at).is_valid()))
        order = some[np.lexsort([-some, longs(column(number))[some], longs(column(at))[some], owner[some]])]
        last = np.append(owner[order][1:] != owner[order][:-1], True)[: len(order)]
        best = np.full(n, -1)
        best[owner[order][last]] = order[last]
        return best

    def items(name: str):
        lists = column(name)
        own = np.repeat(owner, longs(lists.value_lengths()))
        flat = lists.flatten()
        return lists.type, flat, own, longs(flat.field("at")), longs(flat.field("id"))

    reset, base = newest("reset_at", "reset_id"), newest("base_at", "base_id")
    has_base, base_at, base_id = base >= 0, longs(column("base_at"))[base], longs(column("base_id"))[base]
    kind, flat, own, at, number = items("cells")
    name = np.asarray(flat.field("name").dictionary_encode().indices, np.int64)
    order = np.lexsort([-np.arange(len(own)), number, at, name, own])
    group = own[order] * (name.max(initial=0) + 1) + name[order]
    order = order[np.append(group[1:] != group[:-1], True)[: len(order)]]
    cells = _lists(kind, flat.take(pa.array(order)), own[order], n)
    kind, flat, own, at, number = items("steps")
    stays = np.flatnonzero(~has_base[own] | (at > base_at[own]) | ((at == base_at[own]) & (number > base_id[own])))
    stays = stays[np.argsort(own[stays], kind="stable")]
    steps = _lists(kind, flat.take(pa.array(stays)), own[stays], n)
    count, until = longs(column("settled")), longs(column("settled_at"))
    counted = np.flatnonzero((count > 0) & (~has_base[owner] | (base_at[owner] <= until)))
    settled, settled_at, seen = np.zeros(n, np.int64), np.full(n, BEFORE_ALL), np.full(n, BEFORE_ALL)
    np.add.at(settled, owner[counted], count[counted])
    np.maximum.at(settled_at, owner[counted], until[counted])
    np.maximum.at(seen, owner, longs(column("seen")))
    of = lambda name, best: column(name).take(pa.array(best, mask=best < 0))
    made = {
        "doi": keys.dictionary, "cells": cells, "steps": steps, "settled": pa.array(settled), "settled_at": pa.array(settled_at), "seen": pa.array(seen),
        **{c: of(c, reset) for c in ("reset_at", "reset_id")}, **{c: of(c, base) for c in ("base_at", "base_id", "base")},
    }
    return pa.RecordBatch.from_arrays([made[f.name] for f in rows.schema], schema=rows.schema)


def combined(summaries: DataFrame, rows: int = HELD) -> DataFrame:
    """Merge the summaries of a DOI that a task meets close together. A task holds about ``rows`` summaries at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= rows:
                one = merged_rows(pa.Table.from_batches(held))
                held = [one]
                if 2 * one.num_rows > rows:
                    yield one
                    held = []
        if held:
            yield merged_rows(pa.Table.from_batches(held))
        del held
        pa.default_memory_pool().release_unused()

    return summaries.mapInArrow(work, f"doi string, {SUMMARY}")


class Keeper(StatefulProcessor):
    """Merges new summaries into the state of their DOI; a timer at its newest step settles steps the watermark has passed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(VARIABLE, SUMMARY)

    def _held(self) -> tuple | None:
        had = self.state.get()
        return None if had is None else _plain(tuple(had))

    def _wait(self, steps: list[tuple]) -> None:
        self.handle.registerTimer(max(0, max(steps)[0] // 1000 + 1))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = self._held()
        waiting = bool(now and now[1])
        parts = [*([] if now is None else [now]), *map(_plain, rows)]
        now = merged(*parts) if len(parts) > 1 else parts[0]
        self.state.update(now)
        if now[1] and not waiting:
            self._wait(now[1])
        yield Row(doi=key[0], **dict(zip(FIELDS, now)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self._held()
        if now is not None and now[1]:
            now = settled_before(now, timerValues.getCurrentWatermarkInMs() * 1000)
            self.state.update(now)
            if now[1]:
                self._wait(now[1])
        return iter([])

    def handleInitialState(self, key, initialState, timerValues) -> None:
        now = _plain(initialState)
        self.state.update(now)
        if now[1]:
            self._wait(now[1])

    def close(self) -> None:
        pass


# -- the stream --------------------------------------------------------------------------


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def changes_of(events: DataFrame, lateness: str = LATENESS, start: DataFrame | None = None) -> DataFrame:
    """A stream of changed DOIs with their summaries; ``start`` is what the state begins with.

    The watermark is there for the timers. Events behind it still count: nothing is dropped.
    """
    at = F.when(F.col("seen") != BEFORE_ALL, F.timestamp_micros("seen"))
    summaries = event_summaries(events).withColumn("stamp", at).withWatermark("stamp", lateness).drop("stamp")
    first = None if start is None else start.groupBy("doi")
    # A key of the state costs calls to the store for each batch, and a row of it costs Python time: what tasks have merged meets by
    # DOI and is merged again, so that the state takes about one row of a DOI in a batch, however the events are spread.
    met = combined(combined(summaries).repartition("doi"), 2 * HELD)
    return met.groupBy("doi").transformWithState(Keeper(), f"doi string, {SUMMARY}", "Update", "EventTime", first)


def start_ledger(
    events: DataFrame, checkpoint: str, on_change: Callable[[DataFrame, int], None] | None = None, base: DataFrame | None = None,
    lateness: str = LATENESS, interval: str | None = None, idle_batches: bool = True,
) -> StreamingQuery:
    """Keep the ledger of an event stream in the state under ``checkpoint``; read it with :func:`read_ledger`.

    ``on_change`` gets the changed ledger rows of each batch and its number. ``base`` is a ledger to begin with. A batch that
    runs again begins with the state before it, so each event counts once. Without ``idle_batches`` timers fire with the
    next events only, not in a batch of their own.
    """
    spark = events.sparkSession
    kind = events.schema["created_at"].dataType.simpleString()
    start = None
    if base is not None:
        held = as_set_events(base).withColumn("created_at", F.lit(None).cast(kind))
        seen = base.select("doi", _micros(F.col("last_updated").cast(kind), kind).alias("seen"))
        start = combined(event_summaries(held)).drop("seen").join(seen, "doi").select("doi", *FIELDS)
    idle = str(idle_batches).lower()
    with _setting(spark, "spark.sql.streaming.stateStore.providerClass", STORE), _setting(spark, "spark.sql.streaming.noDataMicroBatches.enabled", idle):
        writer = changes_of(events, lateness, start).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        if on_change is None:
            writer = writer.format("noop")
        else:
            writer = writer.foreachBatch(lambda batch, number: on_change(ledger_of(batch, kind), number))
        return writer.trigger(**({"processingTime": interval} if interval else {"availableNow": True})).start()


def newest_batch(spark: SparkSession, checkpoint: str) -> int:
    """The newest finished batch of a stream; -1 if there is none."""
    return max(sinks.numbers_in(spark, f"{checkpoint}/commits"), default=-1)


def read_summaries(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The state itself, as of a batch (the newest by default)."""
    reader = spark.read.format("statestore").option("stateVarName", VARIABLE)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select("key.doi", "value.*")


def read_ledger(spark: SparkSession, checkpoint: str, date_type: str = "timestamp", batch_id: int | None = None) -> DataFrame:
    return ledger_of(read_summaries(spark, checkpoint, batch_id), date_type)


def state_size(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """One row: DOIs held, set columns, steps not settled yet and steps settled."""
    return read_summaries(spark, checkpoint, batch_id).agg(
        F.count(F.lit(1)).alias("dois"), F.coalesce(F.sum(F.size("cells")), F.lit(0)).alias("cells"),
        F.coalesce(F.sum(F.size("steps")), F.lit(0)).alias("steps"), F.coalesce(F.sum("settled"), F.lit(0)).alias("settled"),
    )
