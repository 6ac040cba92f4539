"""The processing ledger as a fold over events and updates.

A change is ``(doi, seq, <column structs>)``: a column struct is NULL when the change
leaves that column alone, and holds the new value (NULL included) when it sets it. The
fold keeps the newest set value per column with ``max_by``, which aggregates on the map
side first, so a DOI with a third of all events costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import status as S
from ..functions.text import has_text_sql, is_value
from ..schemas import (
    DATE_COLUMNS,
    FAILED,
    NO,
    NOT_ATTEMPTED,
    PARSERS,
    SUCCESS,
    TRACKED_SOURCES,
    TRACKER_COLUMNS,
    TRACKER_FILE_DEFAULTS,
    UNKNOWN,
    YES,
    tracker_type,
)
from .gaps import content_flags, keyed, remove_keys, select_keys

DEFAULT_MAX_RETRIES = 3


def _setting(cond: Column, value: Column) -> Column:
    return F.when(cond, F.struct(value.alias("v")))


def _first(*settings: Column) -> Column:
    return F.coalesce(*settings)


def event_settings(date_type: str = "timestamp") -> dict[str, Column]:
    """Column -> struct a ledger event sets it to. ``changes`` carries plain updates.

    Dates have the type of the events' own stamps, so no time zone comes in.
    """
    kind, to, at = F.col("event_type"), F.col("status_to"), F.col("created_at")
    out: dict[str, list[Column]] = {c: [] for c in TRACKER_COLUMNS}

    def put(column: str, cond: Column, value: Column) -> None:
        out[column].append(_setting(cond, value))

    changes = F.col("changes")
    for column in TRACKER_COLUMNS:
        kind_of = date_type if column in DATE_COLUMNS else "string"
        put(column, F.map_contains_key(changes, column), F.try_element_at(changes, F.lit(column)).try_cast(kind_of))
    for column in ("scihub_available", "oa_available"):
        put(column, kind == column, to)

    is_download = kind == "download"
    for source in ("scihub", "oa"):
        put(f"{source}_downloaded", is_download & (to == source), F.lit(YES))
    put("downloaded", is_download, F.when(to == FAILED, NO).otherwise(YES))
    put("download_date", is_download, at)
    put("download_source", is_download & ~to.isin(SUCCESS, FAILED, "unknown_source"), to)

    for source in TRACKED_SOURCES:
        put(f"{source}_attempted", kind == f"{source}_attempted", F.lit(YES))
        fetched = kind == f"{source}_download"
        put(f"{source}_downloaded", fetched, F.when(to == SUCCESS, YES).otherwise(NO))
        put("downloaded", fetched & (to == SUCCESS), F.lit(YES))
        put("download_date", fetched & (to == SUCCESS), at)
        put("download_source", fetched & (to == SUCCESS), F.lit(source))

    message = F.col("message")
    for parser in PARSERS:
        put(f"{parser}_status", kind == parser, to)
        put(f"{parser}_date", kind == parser, at)
        put("error_msg", (kind == parser) & has_text_sql(message), message)
    put("error_msg", kind == "error", message)
    return {column: _first(*settings) for column, settings in out.items()}


def _with_optional(events: DataFrame) -> DataFrame:
    have = set(events.columns)
    for name, kind in (("message", "string"), ("changes", "map<string,string>")):
        if name not in have:
            events = events.withColumn(name, F.lit(None).cast(kind))
    return events


def _retries(events: DataFrame, errors_count: bool) -> DataFrame:
    """Retry count per DOI: increments after the last event that set it.

    Each increment has to be compared with its DOI's last setting event. A busy DOI has its
    increments on the left side of that join, where Spark splits large tasks, and they are
    counted before the next shuffle.
    """
    seq, kind = F.struct("created_at", "id"), F.col("event_type")
    value = F.when(kind == "reset", F.lit(0)).otherwise(
        F.try_element_at(F.col("changes"), F.lit("retry_count")).try_cast("int")
    )
    bases = (
        events.filter((kind == "reset") | F.coalesce(F.map_contains_key("changes", "retry_count"), F.lit(False)))
        .groupBy("doi")
        .agg(F.max(seq).alias("base_seq"), F.max_by(F.struct(value.alias("v")), seq)["v"].alias("base"))
    )
    steps = kind == "retry_increment"
    if errors_count:
        steps = steps | (kind.isin(*PARSERS) & has_text_sql(F.col("message")))
    increments = events.filter(steps).select("doi", "id", seq.alias("seq"))
    counted = (
        increments.join(bases.select("doi", "base_seq"), "doi", "left")
        .filter(F.col("base_seq").isNull() | (F.col("seq") > F.col("base_seq")))
        .groupBy("doi")
        .agg(F.count(F.lit(1)).cast("int").alias("n"), F.lit(0).alias("base"))
    )
    return (
        counted.unionByName(bases.select("doi", F.lit(0).alias("n"), F.coalesce("base", F.lit(0)).alias("base")))
        .groupBy("doi")
        .agg((F.sum("n") + F.sum("base")).cast("int").alias("retry_count"))
    )


def fold(events: DataFrame, errors_count: bool = False) -> DataFrame:
    """Ledger rows (one per DOI) after all events, in ``(created_at, id)`` order.

    ``reset`` clears every column. ``errors_count`` adds a retry for a parser event that
    carries an error message, as the file-based ledger did.
    """
    events = _with_optional(events)
    seq = F.struct("created_at", "id")
    settings = event_settings(events.schema["created_at"].dataType.simpleString())
    staged = events.select(
        "doi", seq.alias("_seq"), "created_at", (F.col("event_type") == "reset").alias("_reset"),
        *[value.alias(f"_{c}") for c, value in settings.items()],
    )
    newest = staged.groupBy("doi").agg(
        F.max("created_at").alias("last_updated"),
        F.max(F.when(F.col("_reset"), F.col("_seq"))).alias("_reset_seq"),
        *[
            F.max_by(F.struct(F.col(f"_{c}")["v"].alias("v"), F.col("_seq").alias("s")), F.when(F.col(f"_{c}").isNotNull(), F.col("_seq"))).alias(f"_{c}")
            for c in TRACKER_COLUMNS
        ],
    )
    alive = {
        c: F.when(
            F.col("_reset_seq").isNull() | (F.col(f"_{c}")["s"] > F.col("_reset_seq")), F.col(f"_{c}")["v"]
        ).alias(c)
        for c in TRACKER_COLUMNS
    }
    return newest.join(_retries(events, errors_count), "doi", "left").select(
        "doi", *alive.values(), "last_updated", F.coalesce("retry_count", F.lit(0)).alias("retry_count")
    )


def upsert(ledger: DataFrame, updates: DataFrame, at: Column, seq: str | None = None) -> DataFrame:
    """Set the columns ``updates`` has, insert absent DOIs, stamp ``last_updated``.

    Rows without a DOI are skipped. Several updates of one DOI apply in ``seq`` order,
    column by column. One union and one grouping; the ledger is never the inner side of
    an outer join.
    """
    given = [c for c in updates.columns if c not in ("doi", seq, "last_updated")]
    order = F.col(seq).cast("long") if seq else F.lit(0).cast("long")
    columns = [c for c in ledger.columns if c != "doi"]

    old = ledger.select(
        "doi", F.lit(-1).cast("long").alias("_seq"),
        *[F.struct(F.col(c).alias("v")).alias(c) for c in columns],
    )
    types = {f.name: f.dataType for f in ledger.schema.fields}

    def cell(column: str) -> Column:
        if column in given:
            return F.struct(F.col(column).cast(types[column]).alias("v"))
        if column == "last_updated":
            return F.struct(at.cast(types[column]).alias("v"))
        return F.lit(None).cast(f"struct<v:{types[column].simpleString()}>")

    new = updates.filter(has_text_sql(F.col("doi"))).select(
        "doi", order.alias("_seq"), *[cell(c).alias(c) for c in columns]
    )
    merged = old.unionByName(new).groupBy("doi").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_seq"))).alias(c) for c in columns]
    )
    return merged.select(
        "doi",
        *[
            (F.coalesce(F.col(c)["v"], F.lit(0)) if c == "retry_count" else F.col(c)["v"]).alias(c)
            for c in columns
        ],
    ).select(ledger.columns)


def patch(ledger: DataFrame, updates: DataFrame, at: Column) -> DataFrame:
    """Like :func:`upsert`, but a NULL in ``updates`` leaves the column alone."""
    given = [c for c in updates.columns if c != "doi"]
    types = {f.name: f.dataType for f in ledger.schema.fields}
    columns = [c for c in ledger.columns if c != "doi"]
    new = updates.filter(has_text_sql(F.col("doi"))).select(
        "doi", F.lit(1).alias("_new"),
        *[
            F.col(c).cast(types[c]).alias(c) if c in given else F.lit(None).cast(types[c]).alias(c)
            for c in columns if c != "last_updated"
        ],
        at.cast(types["last_updated"]).alias("last_updated"),
    )
    both = ledger.withColumn("_new", F.lit(0)).unionByName(new)
    merged = both.groupBy("doi").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_new"))).alias(c) for c in columns])
    return merged.withColumn("retry_count", F.coalesce("retry_count", F.lit(0))).select(ledger.columns)


def add_defaults(ledger: DataFrame) -> DataFrame:
    """Columns an older ledger lacks, added as NULL (additive schema change)."""
    have = set(ledger.columns)
    for c in TRACKER_COLUMNS:
        if c not in have:
            ledger = ledger.withColumn(c, F.lit(None).cast(tracker_type(c)))
    if "last_updated" not in have:
        ledger = ledger.withColumn("last_updated", F.lit(None).cast("timestamp"))
    if "retry_count" not in have:
        ledger = ledger.withColumn("retry_count", F.lit(0))
    return ledger.select("doi", *TRACKER_COLUMNS, "last_updated", "retry_count")


def reset(ledger: DataFrame, keys: DataFrame, at: Column) -> DataFrame:
    """Clear the listed DOIs; a DOI the ledger lacks gets an empty row."""
    wanted = keys.select("doi").distinct()
    cleared = add_defaults(wanted).withColumn("last_updated", at.cast("timestamp"))
    return remove_keys(add_defaults(ledger), wanted).unionByName(cleared)


def remove(ledger: DataFrame, keys: DataFrame) -> DataFrame:
    return remove_keys(ledger, keys)


def removal_preview(ledger: DataFrame, keys: DataFrame) -> DataFrame:
    """What a removal would drop: only listed DOIs that are present count."""
    return select_keys(ledger, keys).select("doi")


# -- views of the ledger ---------------------------------------------------------------


def needs_download() -> Column:
    return is_value(F.col("scihub_available"), YES) & ~is_value(F.col("downloaded"), YES)


def needs_parser(parser: str) -> Column:
    return is_value(F.col("downloaded"), YES) & F.coalesce(
        F.col(f"{parser}_status").isin(NOT_ATTEMPTED, FAILED), F.lit(False)
    )


def pending_by_stage(ledger: DataFrame) -> DataFrame:
    """``(stage, doi)``; a DOI may wait in several stages."""
    stages = F.array(
        F.when(needs_download(), "download"),
        *[F.when(needs_parser(p), p) for p in PARSERS],
    )
    return ledger.select(F.explode(F.filter(stages, lambda s: s.isNotNull())).alias("stage"), "doi")


def retryable(ledger: DataFrame, max_retries: int = DEFAULT_MAX_RETRIES) -> DataFrame:
    """``(category, doi)`` of failures that may be tried again."""
    kinds = F.array(
        F.when(is_value(F.col("downloaded"), NO), "download"),
        *[F.when(is_value(F.col(f"{p}_status"), FAILED), p) for p in PARSERS],
    )
    few = F.coalesce(F.col("retry_count").cast("int"), F.lit(0)) < max_retries
    return ledger.filter(few).select(F.explode(F.filter(kinds, lambda s: s.isNotNull())).alias("category"), "doi")


def parsed_ok(ledger: DataFrame) -> DataFrame:
    """Rows a parser finished, with both parser states."""
    ok = is_value(F.col("pymupdf_status"), SUCCESS) | is_value(F.col("grobid_status"), SUCCESS)
    return ledger.filter(ok).select("doi", "pymupdf_status", "grobid_status")


def next_step(ledger: DataFrame) -> DataFrame:
    def settled(c: str) -> Column:
        return F.coalesce(F.col(c).isin(SUCCESS, FAILED), F.lit(False))

    step = (
        F.when(~is_value(F.col("downloaded"), YES), "Download PDF")
        .when(~settled("pymupdf_status"), "Process with PyMuPDF")
        .when(~settled("grobid_status"), "Process with Grobid")
        .otherwise("Fully processed")
    )
    return ledger.select("doi", step.alias("next_step"))


def statistics(ledger: DataFrame) -> DataFrame:
    """One row of ledger counters."""

    def n(column: str, value: str) -> Column:
        return F.count_if(F.col(column) == value)

    out = {
        "total_dois": F.count(F.lit(1)),
        "scihub_available": n("scihub_available", YES),
        "scihub_not_found": n("scihub_available", NO),
        "downloaded": n("downloaded", YES),
        "download_failed": n("downloaded", NO),
    }
    for p in PARSERS:
        out[f"{p}_success"] = n(f"{p}_status", SUCCESS)
        out[f"{p}_failed"] = n(f"{p}_status", FAILED)
        out[f"{p}_pending"] = n(f"{p}_status", NOT_ATTEMPTED)
    out["fully_processed"] = F.count_if(
        is_value(F.col("pymupdf_status"), SUCCESS) | is_value(F.col("grobid_status"), SUCCESS)
    )
    stats = ledger.agg(*[c.alias(name) for name, c in out.items()])
    return stats.withColumns(
        {
            "scihub_unknown": F.col("total_dois") - F.col("scihub_available") - F.col("scihub_not_found"),
            "completion_pct": F.round(F.try_divide(F.col("fully_processed") * 100.0, F.col("total_dois")), 2),
        }
    )


def pending_counts(ledger: DataFrame) -> DataFrame:
    """One row: not downloaded, not parsed per parser, and parsed by both."""
    fast, structured = (is_value(F.col(f"{p}_status"), SUCCESS) for p in PARSERS)
    return ledger.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~is_value(F.col("downloaded"), YES)).alias("needs_download"),
        F.count_if(~fast).alias("needs_pymupdf"),
        F.count_if(~structured).alias("needs_grobid"),
        F.count_if(fast & structured).alias("complete"),
    )


def status_histogram(ledger: DataFrame, papers: DataFrame) -> DataFrame:
    """Value counts of four ledger columns over DOIs both tables hold."""
    dims = ("scihub_available", "downloaded", "pymupdf_status", "grobid_status")
    both = ledger.join(keyed(papers).select("doi").distinct(), "doi", "left_semi")
    long = both.select(
        F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dims])).alias("x")
    )
    return long.groupBy("x.dimension", "x.value").agg(F.count(F.lit(1)).alias("dois"))


def source_reliability(ledger: DataFrame) -> DataFrame:
    """Attempts, downloads and success rate per source."""
    rows = [
        F.struct(F.lit(s).alias("source"), is_value(F.col(f"{s}_attempted"), YES).alias("attempted"),
                 is_value(F.col(f"{s}_downloaded"), YES).alias("downloaded"))
        for s in TRACKED_SOURCES
    ] + [
        F.struct(F.lit(s).alias("source"), F.col(f"{s}_downloaded").isin(YES, NO).alias("attempted"),
                 is_value(F.col(f"{s}_downloaded"), YES).alias("downloaded"))
        for s in ("scihub", "oa")
    ]
    counts = (
        ledger.select(F.explode(F.array(*rows)).alias("x"))
        .groupBy(F.col("x.source").alias("source"))
        .agg(F.count_if("x.attempted").alias("attempted"), F.count_if("x.downloaded").alias("downloaded"))
    )
    return counts.withColumn("rate", F.round(F.try_divide(F.col("downloaded") * 1.0, F.col("attempted")), 4))


# -- ledger and paper table ------------------------------------------------------------


def encoded(ledger: DataFrame) -> DataFrame:
    status = S.encode_status(
        F.col("grobid_status"), F.col("pymupdf_status"), F.col("downloaded"), F.col("scihub_available")
    )
    return ledger.select("doi", status.alias("parsing_status"))


def export_statuses(papers: DataFrame, ledger: DataFrame) -> DataFrame:
    """``(doi, parsing_status)`` of papers whose status the ledger rewrites."""
    return encoded(ledger).join(keyed(papers).select("doi").distinct(), "doi", "left_semi")


def decoded(papers: DataFrame) -> DataFrame:
    """Ledger updates the status text implies; rows that imply nothing are dropped."""
    columns = S.decode_status(F.col("parsing_status"))
    rows = keyed(papers).select("doi", *[c.alias(name) for name, c in columns.items()])
    return rows.filter(F.coalesce(*[F.col(n) for n in columns]).isNotNull())


def decoded_initial(papers: DataFrame) -> DataFrame:
    columns = S.decode_initial(F.col("parsing_status"), F.col("abstract"), F.col("full_text_sections"))
    rows = keyed(papers).select("doi", *[c.alias(name) for name, c in columns.items()])
    return rows.filter(F.coalesce(*[F.col(n) for n in columns]).isNotNull())


def new_rows(papers: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger rows for DOIs it lacks: decoded status, else the defaults."""
    columns = S.decode_status(F.col("parsing_status"))
    names = list(columns)
    implied = F.coalesce(*columns.values()).isNotNull()
    defaults = {n: UNKNOWN if n in ("scihub_available", "downloaded") else NOT_ATTEMPTED for n in names}
    return (
        keyed(papers)
        .select("doi", "parsing_status")
        .join(ledger.select("doi"), "doi", "left_anti")
        .select("doi", *[F.when(implied, columns[n]).otherwise(F.lit(defaults[n])).alias(n) for n in names])
    )


def _paper_facts(papers: DataFrame) -> DataFrame:
    return (
        content_flags(keyed(papers))
        .groupBy("doi")
        .agg(F.max("has_content").alias("_content"), F.max("has_oa_url").alias("_oa"), F.lit(True).alias("_in_papers"))
    )


def _yes_no(c: Column) -> Column:
    return F.when(c, YES).otherwise(NO)


def _file_row(c: str) -> Column:
    """A file column, or its default where the row is new."""
    return F.when(F.col("_tracked"), F.col(c)).otherwise(F.lit(TRACKER_FILE_DEFAULTS[c])).alias(c)


KEPT = ("downloaded", "download_date", "pymupdf_status", "pymupdf_date", "grobid_status", "grobid_date")


def migrate_file(old: DataFrame, papers: DataFrame) -> DataFrame:
    """Eleven-column tracker rows in the fifteen-column layout.

    Content is judged as SQL does here (a value of spaces counts), the URL after stripping.
    """
    facts = (
        content_flags(keyed(papers))
        .groupBy("doi")
        .agg(
            F.max(has_text_sql(F.col("full_text")) | has_text_sql(F.col("full_text_sections"))).alias("_content"),
            F.max("has_oa_url").alias("_oa"),
        )
    )
    return old.join(facts, "doi", "left").select(
        "doi", "scihub_available", F.col("downloaded").alias("scihub_downloaded"), _yes_no(F.col("_oa")).alias("oa_available"),
        F.lit(UNKNOWN).alias("oa_downloaded"), "downloaded", "download_date", _yes_no(F.col("_content")).alias("has_content_in_db"),
        "pymupdf_status", "pymupdf_date", "grobid_status", "grobid_date", "last_updated", "error_msg", "retry_count",
    )


def rebuild_file(old: DataFrame, papers: DataFrame, artefact_keys: DataFrame, at: Column) -> DataFrame:
    """Fifteen-column tracker over all papers and tracked DOIs.

    ``artefact_keys`` is ``(doi, parser)`` of files present; presence forces success, and
    stored content turns an unknown download into a yes.
    """
    files = artefact_keys.groupBy("doi").agg(*[F.max(F.col("parser") == p).alias(f"_{p}") for p in PARSERS])
    tracked = old.withColumn("_tracked", F.lit(True))
    keys = keyed(papers).select("doi").unionByName(old.select("doi")).distinct()
    joined = (
        keys.join(tracked, "doi", "left").join(_paper_facts(papers), "doi", "left").join(files, "doi", "left")
    )
    downloaded = F.when(F.col("_tracked"), F.col("downloaded")).otherwise(UNKNOWN)
    return joined.select(
        "doi", _file_row("scihub_available"), downloaded.alias("scihub_downloaded"), _yes_no(F.col("_oa")).alias("oa_available"),
        F.lit(UNKNOWN).alias("oa_downloaded"),
        F.when(F.col("_content") & (downloaded == UNKNOWN), YES).otherwise(downloaded).alias("downloaded"),
        _file_row("download_date"), _yes_no(F.col("_content")).alias("has_content_in_db"),
        *[
            col
            for p in PARSERS
            for col in (
                F.when(F.col(f"_{p}"), SUCCESS).when(F.col("_tracked"), F.col(f"{p}_status")).otherwise(NOT_ATTEMPTED).alias(f"{p}_status"),
                _file_row(f"{p}_date"),
            )
        ],
        F.coalesce(F.col("last_updated"), at.cast("string")).alias("last_updated"), _file_row("error_msg"), _file_row("retry_count"),
        F.coalesce(F.col("_in_papers"), F.lit(False)).alias("in_papers"),
    )


def rebuild_statistics(rebuilt: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    parts = {
        "from_papers": F.count_if("in_papers"),
        "scihub_available": F.count_if(F.col("scihub_available") == YES),
        "oa_available": F.count_if(F.col("oa_available") == YES),
        "downloaded": F.count_if(F.col("downloaded") == YES),
        "has_content": F.count_if(F.col("has_content_in_db") == YES),
        "pymupdf_success": F.count_if(F.col("pymupdf_status") == SUCCESS),
        "grobid_success": F.count_if(F.col("grobid_status") == SUCCESS),
    }
    counts = rebuilt.agg(total.alias("total"), *[c.alias(n) for n, c in parts.items()])
    return counts.select(
        "total", *parts, *[F.round(F.try_divide(F.col(n) * 100.0, F.col("total")), 1).alias(f"{n}_pct") for n in parts]
    )
