"""Time headline queries over one data folder and print one JSON line.

``BENCH_SF_DIR`` names the folder (default sf0.1), ``BENCH_CPUS`` the local cores. Every
query is run to its last row into a sink that keeps nothing; ``BENCH_QUERIES`` (comma
separated, or ``all``) picks other queries. ``queries`` are seconds over the folder as it is, where a
table is one file with one row group and so one task; ``queries_in_files`` over the same rows in as many
files as there are cores, laid out before the clock starts, as tables of any size would be.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from corpus_ledger.fixtures import TABLES  # noqa: E402
from corpus_ledger.plans import QUERIES  # noqa: E402
from corpus_ledger.session import local_session, scratch_folder  # noqa: E402

HEADLINE = [
    "work_list",
    "normalize_ids",
    "presence_diff",
    "needs_update",
    "partition_work_fast",
    "waterfall_pick",
    "batches",
    "ledger_fold",
    "ledger_upsert",
    "tracker_stats",
    "source_reliability",
    "json_validity",
    "validity_stats",
    "processing_state",
    "rebuild_tracker",
    "reset_plan",
    "sections_from_blocks",
    "full_text_join",
    "sections_last_wins",
    "references_split",
    "tei_sections",
    "latest_log_entry",
    "import_merge",
    "update_all",
    "stream_ledger_fold",
]


def laid_out(spark, sf_dir: str) -> str:
    """The tables in a new folder, each in as many files as there are cores."""
    folder = f"{scratch_folder(spark)}/{sf_dir.rsplit('/', 1)[-1]}"
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(spark.sparkContext.defaultParallelism).write.parquet(f"{folder}/{name}.parquet")
    return folder


def timed(spark, sf_dir: str, names: list[str]) -> dict[str, float]:
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    picked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if picked == "all" else [n for n in picked.split(",") if n] or HEADLINE
    spark = local_session("corpus_ledger_bench")
    spark.sparkContext.setLogLevel("ERROR")
    # Start the executor threads, the code generator and a Python worker before the clock runs.
    for warm in ("missing_matrix", "json_validity"):
        QUERIES[warm](spark, sf_dir).limit(10).collect()
    seconds = timed(spark, sf_dir, names)
    in_files = timed(spark, laid_out(spark, sf_dir), names)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    total = round(sum(seconds.values()), 3)
    line = {
        "metric": "total_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "queries_in_files": in_files,
        "value_in_files": round(sum(in_files.values()), 3),
        "sf": sf_dir.rsplit("/sf", 1)[-1],
        "cpus": spark.sparkContext.defaultParallelism,
        "documents": documents,
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
