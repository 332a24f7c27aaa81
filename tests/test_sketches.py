import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators.sketches import (Counters, distinct_sketches, estimate, estimated_ngrams, merge_sketches,
                                        relative_bound)
from tessera.operators.text import ngram_counts


def test_rolled_up_estimates_stay_inside_the_bound(spark):
    """200,000 distinct values, each seen on several days, by month and in all."""
    rows = spark.range(600_000).select((F.col("id") % 60).cast("int").alias("day"), ((F.col("id") * 7919) % 200_000).alias("ip"))
    daily = distinct_sketches(rows, ["day"], "ip", lg_k=12)
    monthly = merge_sketches(daily.withColumn("month", F.floor(F.col("day") / 30)), ["month"])
    overall = merge_sketches(daily, [])
    exact = {r.month: r.n for r in rows.groupBy(F.floor(F.col("day") / 30).alias("month")).agg(F.count_distinct("ip").alias("n")).collect()}
    for r in monthly.withColumn("e", estimate()).collect():
        assert abs(r.e - exact[r.month]) <= relative_bound(12) * exact[r.month]
    assert abs(overall.select(estimate().alias("e")).first().e - 200_000) <= relative_bound(12) * 200_000


def test_few_values_nulls_and_empty_groups(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), ("b", None)], "g string, v string")
    got = {r.g: r.e for r in distinct_sketches(rows, ["g"], "v").select("g", estimate().alias("e")).collect()}
    assert got == {"a": 1, "b": 0}
    assert distinct_sketches(rows.filter("g = 'c'"), ["g"], "v").count() == 0


@pytest.mark.parametrize("capacity", [3, 20, 1000])
def test_counters_lose_no_more_than_they_say(capacity):
    rng = random.Random(capacity)
    items = [min(int(rng.paretovariate(0.8)), 5000) for _ in range(20_000)]
    counters = Counters(capacity)
    for i in range(0, len(items), 37):
        counters.add(items[i:i + 37])
    counters.shrink()
    assert len(counters.held) <= capacity and counters.lost <= len(items) / capacity
    for item, n in Counter(items).items():
        assert counters.held.get(item, 0) <= n <= counters.held.get(item, 0) + counters.lost


@pytest.mark.parametrize("capacity", [50, 100_000])
def test_bounds_hold_the_exact_counts(spark, capacity):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    rows = [(g, rng.choices(vocabulary, weights, k=rng.randint(0, 40))) for g in ("a", "b", None) for _ in range(150)] + [("a", None), ("a", ["w1"])]
    df = spark.createDataFrame(rows, "g string, words array<string>").repartition(5)
    found = {(r.g, r.ngram): (r.at_least, r.at_most) for r in estimated_ngrams(df, 2, group=["g"], capacity=capacity).collect()}
    gap = {b - a for a, b in found.values()}
    total = sum(max(len(w) - 1, 0) for _, w in rows if w)
    assert len(gap) == 1 and max(gap) <= total / capacity
    for r in ngram_counts(df, 2, group=["g"]).collect():
        low, high = found.get((r.g, r.ngram), (0, max(gap)))
        assert low <= r.estfrequency <= high
    if capacity > 1000:
        assert gap == {0}


def test_no_words_no_ngrams(spark):
    df = spark.createDataFrame([([],), (None,), (["one"],)], "words array<string>")
    assert estimated_ngrams(df, 2).count() == 0
    assert [tuple(r) for r in estimated_ngrams(df, 1).collect()] == [("one", 1, 1)]
