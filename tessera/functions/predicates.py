"""Reusable predicates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholder strings that mean "no value" in exported text.
INVALID_TEXT = ("", "null")


def valid_value(c: Column | str, invalid: Iterable[str] = INVALID_TEXT) -> Column:
    """Not null and not one of the placeholder strings."""
    col = F.col(c) if isinstance(c, str) else c
    return col.isNotNull() & ~col.isin(*invalid)


def half_open(c: Column | str, low, high) -> Column:
    """low <= c < high (reaches Parquet as two pushed comparisons)."""
    col = F.col(c) if isinstance(c, str) else c
    return (col >= low) & (col < high)
