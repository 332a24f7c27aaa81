"""Joins.

Whether a side is broadcast is left to the optimizer and AQE, which know sizes
in bytes.  The one exception is a side whose row count is fixed by the query
itself (the ``k`` rows of a top-k): that is broadcast by name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Most rows that a query-fixed bound may have to be broadcast by name.
MAX_FIXED_ROWS = 100_000


def left_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """Left outer join of a fact table to a dimension; duplicate dimension
    keys fan out, null or unmatched keys keep the fact row with nulls."""
    return fact.join(dim, on, "left")


def semi_join(df: DataFrame, keys: DataFrame, on: str | Sequence[str] | Column, *,
              fixed_rows: int | None = None) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys`` (each row at most once).
    ``fixed_rows``: a row count that ``keys`` cannot exceed by construction."""
    if fixed_rows is not None and fixed_rows <= MAX_FIXED_ROWS:
        keys = F.broadcast(keys)
    return df.join(keys, on, "left_semi")
