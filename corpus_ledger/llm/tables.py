"""Tables a job writes between its steps, in the folder all executors share."""

from __future__ import annotations

import gc
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def unused(df: DataFrame, name: str) -> str:
    """A column name ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def new_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: later steps neither recompute it nor depend on lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[back] = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made and that nothing reads any more."""
    for df in tables:
        path = _paths.pop(df, None)
        if path is not None:
            sc = df.sparkSession.sparkContext
            there = sc._jvm.org.apache.hadoop.fs.Path(path)
            there.getFileSystem(sc._jsc.hadoopConfiguration()).delete(there, True)


def shared(spark: SparkSession, value):
    """Broadcast what an object holds (arrays, lists and numbers), not its class.

    A broadcast is a plain pickle: one of a class of this package could only be opened where the package can be imported. The class
    goes to the tasks with their code, and :func:`opened` puts the two together there.
    """
    return spark.sparkContext.broadcast(None if value is None else vars(value))


def opened(kind: type, handle):
    """The object of a class that was shared."""
    if handle.value is None:
        return None
    value = object.__new__(kind)
    value.__dict__.update(handle.value)
    return value


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffle files of finished steps now, not whenever the driver next runs short of memory."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
