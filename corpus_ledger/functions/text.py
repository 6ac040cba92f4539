"""Text predicates. Blank has two meanings in the data model; both are kept by name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters removed when a value is stripped of white space.
SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same characters as a pattern class, for patterns that start with (?U). Java reads its
# own Unicode class an order of magnitude faster than a list of the characters.
SPACE_CLASS = r"\s\x1c-\x1f"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE))


def is_blank_sql(c: Column) -> Column:
    """NULL or the empty string; a value of spaces is *not* blank."""
    return c.isNull() | (c == F.lit(""))


def has_text_sql(c: Column) -> Column:
    return c.isNotNull() & (c != F.lit(""))


def has_text(c: Column) -> Column:
    """At least one character that is not white space; never NULL."""
    return F.coalesce(strip(c) != F.lit(""), F.lit(False))


def is_value(c: Column, value: str) -> Column:
    """Equality that is false, not unknown, on NULL."""
    return c.eqNullSafe(F.lit(value))


def contains_ci(c: Column, needle: str) -> Column:
    """Case-insensitive substring test, false on NULL."""
    return F.coalesce(F.lower(c).contains(needle.lower()), F.lit(False))


def collapse_spaces(c: Column) -> Column:
    return strip(F.regexp_replace(c, f"(?U)[{SPACE_CLASS}]+", " "))


def has_fewer_words(stripped: Column, n: int) -> Column:
    """Fewer than ``n`` words in a stripped text; reading stops at the ``n``-th."""
    return ~stripped.rlike(f"(?U)^(?:[^{SPACE_CLASS}]++[{SPACE_CLASS}]++){{{n - 1}}}[^{SPACE_CLASS}]")


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def spread_key(key: Column, row_key: Column) -> Column:
    """A join key for rows whose real key is NULL or empty.

    All such rows would hash to one task. They cannot match anything, so each gets a
    key of its own; the control character keeps it apart from real keys.
    """
    return F.coalesce(null_if_empty(key), F.concat(F.lit("\x01"), row_key.cast("string")))
