from collections import Counter

from pyspark.sql import functions as F

from tessera.operators.relational import top_k, union_all
from tessera.plans.ratings import rating_extremes, rated_products
from tessera.plans.social import category_counts, topk_with_breakdown


def brute_force_topk(data, k):
    valid = [(c, s) for c, s in data if c is not None and c not in ("", "null")]
    counts = Counter()
    groups = set()
    for c, s in valid:
        groups.add((c, s))
        if s is not None:
            counts[(c, s)] += 1
    totals = Counter()
    for (c, s), n in counts.items():
        totals[c] += n
    for c, s in groups:
        totals.setdefault(c, 0)
    top = [c for c, _ in sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:k]]
    return sorted(((c, s, counts[(c, s)]) for c, s in groups if c in top and s is not None), key=repr)


def test_topk_breakdown_matches_brute_force(spark):
    data = [("A", 1)] * 5 + [("A", None)] * 3 + [("B", 2)] * 4 + [("B", 0)] + [("C", 1)] * 5 \
        + [("D", 1)] * 5 + [(None, 1)] * 9 + [("", 2)] * 9 + [("null", 0)] * 9 + [("E", None)] * 7
    df = spark.createDataFrame(data, "country string, sentiment int")
    for k in (1, 2, 3, 10):
        got = sorted((tuple(r) for r in topk_with_breakdown(df.repartition(3), k=k).collect()), key=repr)
        assert got == brute_force_topk(data, k), k


def test_null_category_counts_zero(spark):
    df = spark.createDataFrame([("A", None), ("A", None), ("A", 1)], "country string, sentiment int")
    got = {(r.country, r.sentiment): r.cnt for r in category_counts(df).collect()}
    assert got == {("A", None): 0, ("A", 1): 1}


def test_top_k_partition_independent(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(200)], "g int, v int")
    want = [tuple(r) for r in top_k(df, 5, [F.col("g").desc()], ["v"]).collect()]
    for parts in (1, 5, 17):
        assert [tuple(r) for r in top_k(df.repartition(parts), 5, [F.col("g").desc()], ["v"]).collect()] == want


def test_union_count_and_rating_extremes(spark):
    a = spark.createDataFrame([(1, 5.0)] * 3 + [(2, 1.0)] * 3, "prod_id int, rating double")
    b = spark.createDataFrame([(1, 4.0)] * 3 + [(3, 2.0)] * 2, "prod_id int, rating double")
    u = union_all(a, b, by_name=False)
    assert u.count() == a.count() + b.count()
    rated = {r.prod_id: (r.avg_rating, r.num) for r in rated_products(u, 3).collect()}
    assert rated == {1: (4.5, 6), 2: (1.0, 3)}
    ext = {r.extreme: r.prod_id for r in rating_extremes(u, 3).collect()}
    assert ext == {"best": 1, "worst": 2}
