"""Typed access to JSON of varying shape through VARIANT.

Parse once into a column of its own (a ``withColumn`` step) and pass that column on:
Spark keeps a costly expression that is used more than once in its own projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(body: Column) -> Column:
    """VARIANT of a JSON text, NULL when it is malformed."""
    return F.try_parse_json(body)


def at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def as_text(v: Column) -> Column:
    """The string itself; NULL for any other JSON type."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def text_at(v: Column, path: str) -> Column:
    return as_text(at(v, path))


def items_at(v: Column, path: str = "$") -> Column:
    """Array items as VARIANT; NULL when there is no array."""
    return F.try_variant_get(v, path, "array<variant>")


def is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def key_count(v: Column) -> Column:
    return F.array_size(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")))


def is_null(v: Column) -> Column:
    """JSON null (an absent key is NULL instead)."""
    return F.coalesce(F.is_variant_null(v), F.lit(False))


def is_truthy(v: Column) -> Column:
    """A text, list or object that is not empty, a number that is not zero, or true."""
    return F.when(v.isNull() | is_null(v), F.lit(False)).otherwise(
        F.coalesce(
            as_text(v) != "",
            F.array_size(items_at(v)) > 0,
            key_count(v) > 0,
            ~F.to_json(v).isin("0", "0.0", "false"),
            F.lit(False),
        )
    )


def joined_text(v: Column, sep: str = "\n\n") -> Column:
    """A text, or a list of texts joined by ``sep``."""
    return F.coalesce(
        F.array_join(F.try_variant_get(v, "$", "array<string>"), sep), F.try_variant_get(v, "$", "string")
    )
