from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corpus_ledger.session import local_session  # noqa: E402


# Started on import: test modules build column expressions at module level.
SESSION = local_session("corpus_ledger_tests")
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture()
def one(spark):
    """Value of an expression over one row of named string columns."""

    def run(expression, **values):
        schema = ", ".join(f"{k} string" for k in values)
        return spark.createDataFrame([tuple(values.values())], schema).select(expression.alias("x")).first()["x"]

    return run


@pytest.fixture()
def column(spark):
    """Values of an expression over a list of strings in column ``v``."""

    def run(expression, values):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r["x"] for r in rows.select("i", expression.alias("x")).orderBy("i").collect()]

    return run
