"""Row numbers and batches that never gather a table in one task and run nothing before they are asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges a table is numbered in are this power of two.
RANGE_BITS = 10


def _borders(keys: DataFrame, bits: int) -> DataFrame:
    """One row: the sorted ``borders`` of up to ``2**bits`` ranges of ``(key, h)``.

    Of each of so many hash buckets of keys the one with the least hash is a border: a fair sample of the distinct
    keys that depends on nothing but the keys, so every run and every task gets the same. The least hashes are sums of
    fixed size; a second look at the keys finds what they belong to.
    """
    least = keys.groupBy(F.pmod(F.xxhash64("h"), F.lit(1 << bits)).alias("bucket")).agg(F.min("h").alias("h"))
    sampled = keys.join(F.broadcast(least.select("h")), "h", "left_semi")
    return sampled.agg(F.sort_array(F.collect_set("key")).alias("borders"))


def with_row_number(df: DataFrame, *order: str, name: str = "rn", total: str = "total", bits: int = RANGE_BITS) -> DataFrame:
    """Number rows from 1 in the order of some columns (ascending, NULL first) and add the row total.

    Rows are numbered within ranges of their key, and each range starts after the rows of those before it. Borders and
    counts are tables of at most ``2**bits`` rows, made by the same plan: nothing runs until the result does, and what
    runs again places every row alike. The input is read four times, so it should be a stored table. Rows with equal
    order columns are told apart by a hash of the row, so a frequent key spreads over ranges; only rows alike in
    all columns stay in one.
    """
    row_hash = F.xxhash64(*df.columns)
    key = F.struct(*[F.col(c) for c in order], row_hash.alias("_h"))
    borders = _borders(df.select(key.alias("key"), F.xxhash64(row_hash).alias("h")), bits).scalar()
    placed = df.withColumns({"_key": key, "_range": F.lit(0)})
    for k in reversed(range(bits + 1)):  # binary search: how many borders are not above the key
        step = 1 << k
        further = F.get(borders, F.col("_range") + (step - 1)) <= F.col("_key")  # NULL beyond the last border
        placed = placed.withColumn("_range", F.col("_range") + F.when(further, step).otherwise(0))
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(everything).alias(total))
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_key"))
    return (
        placed.withColumn("_place", place)
        .join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .select(*df.columns, total, name)
    )


def in_batches(df: DataFrame, size: int, *order: str) -> DataFrame:
    """Fixed-size batches in order, with ``batch``, ``n_batches`` and ``batch_name``; the last may be short."""
    numbered = with_row_number(df, *order, total="_total")
    return numbered.withColumns(
        {
            "batch": F.floor((F.col("rn") - 1) / F.lit(size)).cast("long") + 1,
            "n_batches": F.ceil(F.col("_total") / F.lit(size)).cast("long"),
        }
    ).select(
        *df.columns, "rn", "batch", "n_batches", F.format_string("batch_%d_of_%d", "batch", "n_batches").alias("batch_name")
    )
