"""Session helpers: defaults for local runs and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "corpus_ledger", cores: int | str | None = None) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        # A small input of several row groups or files is read by all cores.
        .config("spark.sql.files.minPartitionNum", str(cores))
        .config("spark.sql.files.openCostInBytes", str(64 << 10))
        .config("spark.driver.memory", "8g")
        # Lists of a few spans or sections per group: keep more groups hashed before sorting.
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "20000")
        # No stack trace is recorded for each column expression; building a plan is twice as fast.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder lineage is cut into.

    A cluster names a shared folder in ``spark.checkpoint.dir``; a folder of our
    own is made only in local mode, where every task sees the same disk.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-checkpoint-", dir="/tmp"))
    return sc.getCheckpointDir()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder all executors see, for the tables and checkpoints of one run."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/run-{uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so a lost executor cannot change its partitions."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
