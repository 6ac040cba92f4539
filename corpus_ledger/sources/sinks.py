"""Writers. A table is never overwritten while it is read: each run writes a version of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.identifiers import FAST_SUFFIX
from ..operators.numbering import in_batches
from ..operators.reports import RUN_STATES
from ..schemas import PARSERS
from .files import write_files


def write_identifiers(df: DataFrame, path: str, column: str = "doi") -> None:
    """Sorted identifier list as text. The part files, read in name order, are the sorted list."""
    lines = df.select(F.col(column).cast("string").alias("value")).orderBy("value")
    lines.write.mode("errorifexists").text(path)


def write_stamped(df: DataFrame, root: str, run_ts: str, column: str = "doi") -> str:
    path = f"{root}/run_ts={run_ts}"
    write_identifiers(df, path, column)
    return path


def write_documents(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON file per extraction, ``<stem>.json`` or ``<stem>_fast.json``: all of them, or none if the job fails."""
    suffix = F.when(F.col("parser") == PARSERS[0], FAST_SUFFIX).otherwise("")
    write_files(df.select(F.concat("stem", suffix, F.lit(".json")).alias("name"), "body"), path, mode=mode)


def write_raw_markup(df: DataFrame, path: str, mode: str = "append") -> None:
    """One ``<doc_id>.tei.xml`` per document."""
    write_files(df.select(F.concat(F.col("doc_id").cast("string"), F.lit(".tei.xml")).alias("name"), F.col("tei").alias("body")), path, mode=mode)


def write_results_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").csv(path, header=True, escape='"')


def write_results_json(results: DataFrame, path: str, run_ts: str) -> None:
    """Result rows, and a row of statistics per status beside them.

    The known statuses are counted while the rows are written, so results are computed once. Rows with any other status
    are counted from what was written.
    """
    known = {f"n{k}": s for k, s in enumerate(RUN_STATES)}
    seen = Observation()
    counts = [F.count_if(F.col("status") == s).alias(n) for n, s in known.items()]
    counted = results.observe(seen, F.count(F.lit(1)).alias("all"), *counts)
    counted.write.mode("errorifexists").json(f"{path}/results")
    spark, got = results.sparkSession, seen.get
    rows = [(s, got[n]) for n, s in known.items() if got[n]]
    if sum(n for _, n in rows) < got["all"]:
        written = spark.read.schema("status string").json(f"{path}/results").groupBy("status").agg(F.count(F.lit(1)).alias("papers"))
    else:
        written = spark.createDataFrame(rows, "status string, papers bigint")
    written.withColumn("timestamp", F.lit(run_ts)).coalesce(1).write.mode("errorifexists").json(f"{path}/statistics")


def write_tracker_file(ledger: DataFrame, path: str) -> None:
    """Tracker CSV sorted by DOI."""
    ledger.orderBy("doi").write.mode("errorifexists").csv(path, header=True, escape='"')


def append_events(events: DataFrame, path: str) -> None:
    events.write.mode("append").parquet(path)


def write_batches(df: DataFrame, path: str, size: int, *order: str) -> None:
    """Batches of a list as text under ``batch_name=batch_i_of_n``."""
    rows = in_batches(df, size, *order)
    value = F.col(df.columns[0]).cast("string").alias("value")
    rows.select(value, "batch_name").write.partitionBy("batch_name").mode("errorifexists").text(path)


def write_by_status(results: DataFrame, path: str) -> None:
    """Results split by status, one folder each."""
    results.write.partitionBy("status").mode("append").json(path)


def write_report(results: DataFrame, path: str) -> None:
    """Per-status sections, the counts, and the list to try again."""
    from ..operators import reports

    write_by_status(results, f"{path}/by_status")
    reports.run_report(results).coalesce(1).write.mode("errorifexists").json(f"{path}/summary")
    write_identifiers(reports.retry_list(results), f"{path}/retry", "identifier")


def write_stage_lists(pending: DataFrame, path: str) -> None:
    """Pending DOIs of each stage, ``stage=`` folders of sorted text."""
    rows = pending.select(F.col("doi").alias("value"), "stage").repartitionByRange("stage", "value")
    rows.sortWithinPartitions("stage", "value").write.partitionBy("stage").mode("errorifexists").text(path)


def write_quarantine(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_routed(routed: DataFrame, path: str) -> None:
    """Good and bad rows in one write, each route a folder of its own; a route read back is a scan of its folder."""
    routed.write.partitionBy("route").mode("errorifexists").parquet(path)


# -- snapshots -------------------------------------------------------------------------


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def latest_version(spark: SparkSession, root: str, below: int | None = None) -> int | None:
    """Highest finished version under ``root`` (one listing of a small folder)."""
    fs, path = _file_system(spark, root)
    if not fs.exists(path):
        return None
    done = []
    for entry in fs.listStatus(path):
        name = entry.getPath().getName()
        if name.startswith("version="):
            number = int(name.removeprefix("version="))
            marker = spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")
            if fs.exists(marker) and (below is None or number < below):
                done.append(number)
    return max(done, default=None)


def read_snapshot(spark: SparkSession, root: str, below: int | None = None) -> DataFrame | None:
    version = latest_version(spark, root, below)
    return None if version is None else spark.read.parquet(f"{root}/version={version}")


def write_snapshot(df: DataFrame, root: str, version: int) -> None:
    """Write one version. Writing the same version again replaces it, so a retried run is safe."""
    df.write.mode("overwrite").parquet(f"{root}/version={version}")


def exists(spark: SparkSession, path: str) -> bool:
    fs, found = _file_system(spark, path)
    return fs.exists(found)


def numbers_in(spark: SparkSession, folder: str, prefix: str = "") -> set[int]:
    """Names below a folder that are numbers, after a prefix."""
    fs, path = _file_system(spark, folder)
    names = [entry.getPath().getName() for entry in fs.listStatus(path)] if fs.exists(path) else []
    own = [n.removeprefix(prefix) for n in names if n.startswith(prefix)]
    return {int(n) for n in own if n.lstrip("-").isdigit()}


def noted(spark: SparkSession, folder: str, number: int) -> int:
    """The number noted under a folder; the first call notes its own (as the name of an empty file)."""
    known = numbers_in(spark, folder)
    if known:
        return min(known)
    fs, path = _file_system(spark, f"{folder}/{number}")
    fs.createNewFile(path)
    return number
