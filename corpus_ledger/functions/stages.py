"""Keep a costly column from being computed again.

Spark moves filters below projections and copies the projected expression into them, so a
parsed document would be parsed again for every filter on something read from it. A
generator that yields exactly one row is a border filters do not cross.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed once per row, whatever is built on top of them."""
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)).alias(*columns))
