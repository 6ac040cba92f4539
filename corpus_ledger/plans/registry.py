"""Registered queries: a Spark job over the driver tables, and the same result in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, *views: str, sql: str | None = None):
    """Register a job under ``name``; ``views`` are put in front of ``sql`` as CTEs."""

    def register(job: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = job
        if sql is not None:
            ORACLES[name] = fixtures.oracle(*views, sql=sql)
        return job

    return register


class Source:
    """Short access to the derived relations of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in fixtures.VIEWS:
            return fixtures.view(self.spark, self.sf_dir, name)
        if name in fixtures.TABLES:
            return fixtures.table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    @property
    def bodies(self) -> DataFrame:
        return fixtures.extraction_bodies(self.spark, self.sf_dir)

    @property
    def spans(self) -> DataFrame:
        return fixtures.layout_spans(self.spark, self.sf_dir)

    @property
    def presence(self) -> DataFrame:
        """Extraction presence without bodies; every extraction here holds some bytes."""
        from pyspark.sql import functions as F

        return self.extractions.select("stem", "parser", F.lit(1).cast("long").alias("length"))
