"""K1 — top-k entities with a per-category breakdown.

(country, sentiment) counts restricted to the ``k`` countries with the most
scored messages.  Plan: one partial+final aggregate on (country, sentiment);
the per-country totals and their top-k (k rows, a proven broadcast bound)
are derived from it; a broadcast left-semi join keeps the breakdown rows of
those countries.  Hot countries cost nothing extra: every aggregate combines
map-side before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.predicates import INVALID_TEXT, valid_value
from tessera.operators.joins import semi_join
from tessera.operators.relational import top_k


def category_counts(df: DataFrame, entity: str = "country", category: str = "sentiment",
                    invalid=INVALID_TEXT) -> DataFrame:
    """count of non-null ``category`` per (entity, category) over rows with a
    valid entity; a null category forms its own group with count 0."""
    return (df.filter(valid_value(entity, invalid))
              .groupBy(entity, category).agg(F.count(category).alias("cnt")))


def top_entities(counts: DataFrame, k: int = 10, entity: str = "country") -> DataFrame:
    totals = counts.groupBy(entity).agg(F.sum("cnt").alias("cnt2"))
    return top_k(totals, k, [F.col("cnt2").desc()], [F.col(entity)])


def topk_with_breakdown(df: DataFrame, k: int = 10, entity: str = "country", category: str = "sentiment",
                        invalid=INVALID_TEXT) -> DataFrame:
    """Breakdown rows (entity, category, cnt) of the top-k entities, null
    category removed, most frequent first.

    The null-category filter is written as ``cnt > 0`` inside the semi-join
    condition (``count(category)`` is 0 exactly for the null group).  A
    condition on an aggregate output keeps Catalyst from pushing the semi
    join below the aggregate, so both branches share one aggregate exchange
    (reused at runtime) and the input is scanned once.
    """
    counts = category_counts(df, entity, category, invalid)
    top = top_entities(counts, k, entity).select(F.col(entity).alias("_top_entity"))
    cond = (F.col(entity) == F.col("_top_entity")) & (F.col("cnt") > 0)
    kept = semi_join(counts, top, cond, fixed_rows=k)
    return kept.select(entity, category, "cnt").orderBy(F.col("cnt").desc(), F.col(entity), F.col(category))
