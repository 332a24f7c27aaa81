import random
from collections import Counter

import pyarrow as pa
import pytest

from tessera.operators import grams as G
from tessera.operators.sketches import Counters, estimated_ngrams
from tessera.operators.text import context_ngrams, ngram_counts, ngram_frequency


def rows_of(groups, n, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(2000)]
    weights = [1 / (i + 1) for i in range(2000)]
    return [(rng.choice(groups), rng.choices(words, weights, k=rng.randint(0, 60))) for _ in range(n)]


def brute(rows, n):
    return Counter((g, " ".join(w[i:i + n])) for g, w in rows for i in range(len(w or []) - n + 1))


def top(counts, k):
    by = {}
    for (g, gram), c in counts.items():
        by.setdefault(g, []).append((-c, gram))
    return {(g, gram, -c) for g, found in by.items() for c, gram in sorted(found)[:k]}


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_first_ngrams_of_groups(spark, n):
    rows = rows_of([0.0, -0.0, 1.5, None], 800) + [(7.0, ["once", "only", "here"]), (7.0, None), (1.5, [])]
    df = spark.createDataFrame(rows, "g double, words array<string>").repartition(4)
    want = top(brute([(None if g is None else g + 0.0, w) for g, w in rows], n), 3)
    got = {(r.g, r.ngram, r.estfrequency) for r in ngram_frequency(df, n, 3, group=["g"]).collect()}
    assert got == want


def test_ngrams_that_cannot_be_first_stay_in_their_task(spark):
    """No one trigram in ten reaches the shuffle, and none of the first is missing."""
    rows = rows_of(["a", "b"], 2000, seed=2)
    df = spark.createDataFrame(rows, "g string, words array<string>").repartition(3)
    found = G.bounds(df, 3, 2, "words", ["g"])
    batch = pa.RecordBatch.from_arrays([pa.array([g for g, _ in rows]), pa.array([w for _, w in rows], pa.list_(pa.string()))], names=["g", "w"])
    row, grams, times, _ = G.counted(batch, 3)
    may = found.may_be_first(batch, row, grams)
    kept = {(rows[i][0], g) for i, g, m in zip(row.tolist(), grams.to_pylist(), may.tolist(), strict=True) if m}
    assert {(g, gram) for g, gram, _ in top(brute(rows, 3), 2)} <= kept and may.sum() < len(may) / 10


def test_words_with_blanks_and_nulls_count_by_the_ngrams_text(spark):
    rows = [(["a b", "c", "d"],), (["a", "b c", "d"],), (["a", None, "b c", "d"],), ([None, None],)] * 3
    df = spark.createDataFrame(rows, "words array<string>").repartition(2)
    assert {r.ngram: r.estfrequency for r in ngram_counts(df, 3).collect()} == {"a b c d": 6, "a b c": 3, "b c d": 3}
    assert [(r.ngram, r.estfrequency) for r in ngram_frequency(df, 3, 1).collect()] == [("a b c d", 6)]


def test_packed_numbers_of_many_words():
    rng = random.Random(3)
    codes = [[rng.randrange(3) for _ in range(400)] for _ in range(12)]
    import numpy as np
    key = G.packed([(np.array(c, np.int64), 1 << 20) for c in codes])
    assert len({*key.tolist()}) == len({*zip(*codes)})
    same = {}
    assert all(same.setdefault(t, k) == k for t, k in zip(zip(*codes), key.tolist(), strict=True))


def test_contexts_make_no_row_a_word(spark):
    df = spark.createDataFrame([(["a", "b", "c", "a", None, "c"],)], "words array<string>")
    found = context_ngrams(df, [("a", None, "c"), (None, "b"), ("z",)], exact=True)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r.context, r.ngram, r.estfrequency) for r in found.collect()} == {("a null c", "a b c", 1), ("a null c", "a c", 1), ("null b", "a b", 1)}


@pytest.mark.parametrize("capacity", [5, 40])
def test_slices_are_cut_before_they_come_to_the_counters(spark, capacity):
    rows = rows_of(["x"], 300, seed=4)
    exact = Counter({gram: c for (_, gram), c in brute(rows, 2).items()})
    counters = Counters(capacity)
    for i in range(0, len(rows), 30):
        batch = pa.RecordBatch.from_arrays([pa.array([w for _, w in rows[i:i + 30]], pa.list_(pa.string()))], names=["w"])
        _, grams, times, cut = G.counted(batch, 2, capacity)
        assert len(times) <= capacity
        counters.lost += cut
        counters.merge(zip(grams.to_pylist(), times.tolist(), strict=True))
    counters.shrink()
    assert len(counters.held) <= capacity and counters.lost <= sum(exact.values()) / capacity
    assert all(counters.held.get(g, 0) <= c <= counters.held.get(g, 0) + counters.lost for g, c in exact.items())
    df = spark.createDataFrame(rows, "g string, words array<string>").repartition(2)
    for r in estimated_ngrams(df, 2, capacity=capacity).collect():
        assert r.at_least <= exact[r.ngram] <= r.at_most and r.at_most - r.at_least <= sum(exact.values()) / capacity
