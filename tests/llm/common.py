"""Small frames with awkward rows: NULLs, empty and long texts, repeats, and a column whose name clashes."""

from __future__ import annotations


def frame(spark, rows, clash="spans"):
    return spark.createDataFrame([(i, t, "clash") for i, t in rows], f"doc_id bigint, text string, {clash} string")
