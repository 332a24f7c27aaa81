"""K2/K3 — access-log summaries.

Both group on a few columns and count distinct client IPs.  Catalyst plans
``count(distinct)`` as aggregate-by-(keys, ip) then aggregate-by-keys, each
with a map-side partial step; the first shuffle is keyed by the IP too, so
a hot page or referrer is spread over many tasks.  The top-k is a bounded
per-task top-k, never a global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.predicates import half_open
from tessera.functions.temporal import date_parts
from tessera.functions.weblog import page_key
from tessera.operators.relational import top_k


def client_errors(logs: DataFrame, k: int | None = 10, low: int = 400, high: int = 500) -> DataFrame:
    """Distinct client IPs per (status, referrer, page) for status in
    [low, high); the ``k`` largest (all when k is None)."""
    grouped = (logs.filter(half_open("sc_status", low, high))
                   .withColumn("cs_page", page_key("cs_uristem", "cs_uriquery"))
                   .groupBy("sc_status", "cs_referer", "cs_page")
                   .agg(F.count_distinct("c_ip").alias("cnt")))
    keys = [F.col("sc_status"), F.col("cs_referer").asc_nulls_first(), F.col("cs_page").asc_nulls_first()]
    if k is None:
        return grouped
    return top_k(grouped, k, [F.col("cnt").desc()], keys)


def referrers_per_day(logs: DataFrame, k: int | None = 10, low: int = 200, high: int = 300) -> DataFrame:
    """Distinct client IPs per (year, month, day, referrer) for successful
    requests; the ``k`` largest (all when k is None)."""
    parts = date_parts("date")
    grouped = (logs.filter(half_open("sc_status", low, high))
                   .withColumns(parts)
                   .groupBy("year", "month", "day", "cs_referer")
                   .agg(F.count_distinct("c_ip").alias("cnt")))
    if k is None:
        return grouped
    keys = [F.col(c).asc_nulls_first() for c in ("year", "month", "day", "cs_referer")]
    return top_k(grouped, k, [F.col("cnt").desc()], keys).select("year", "month", "day", "cs_referer", "cnt")
