"""Row generators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, array: Column, alias: str, keep=(), pos_alias: str | None = None) -> DataFrame:
    """``explode`` (one row per element; null or empty arrays give none)
    written so the optimizer adds no inferred ``size(array) > 0`` filter in
    front of the generator.  That filter re-evaluates the whole array
    expression (tokenising, n-gram building) a second time and can be
    pushed far below the generator.  With the outer generator the array is
    computed once; the null position marks the rows of null/empty arrays."""
    pos = pos_alias or "_pos"
    out = df.select(*keep, F.posexplode_outer(array).alias(pos, alias)).filter(F.col(pos).isNotNull())
    return out if pos_alias else out.drop(pos)
