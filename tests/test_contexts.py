import random
from collections import Counter

import pytest

from tessera.operators.text import context_ngram, context_ngrams

VOCABULARY = ["the", "red", "redder", "re", "of", "", "a", "null-ish", "\\E.", "x y"[:1], "é"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    return [[rng.choice(VOCABULARY) for _ in range(rng.randint(0, 25))] for _ in range(60)] + [None, []]


@pytest.fixture(scope="module")
def df(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "words array<string>").repartition(3)


def random_contexts(n):
    rng = random.Random(n)
    return [tuple(rng.choice([None, *VOCABULARY]) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def brute(texts, contexts, exact):
    out = Counter()
    for c in set(contexts):
        for t in texts:
            for i in range(len(t or []) - len(c) + 1):
                gram = t[i:i + len(c)]
                last = len(c) - 1
                if all(w is None or w == g or (not exact and j == last and g.startswith(w)) for j, (w, g) in enumerate(zip(c, gram, strict=True))):
                    out[" ".join("null" if w is None else w for w in c), " ".join(gram)] += 1
    return out


@pytest.mark.parametrize("exact", [True, False])
def test_a_thousand_contexts_in_one_scan(df, texts, exact):
    contexts = random_contexts(1000)
    found = context_ngrams(df, contexts, exact=exact)
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") <= 2  # the texts and the contexts
    got = {(r.context, r.ngram): r.estfrequency for r in found.collect()}
    assert got == dict(brute(texts, contexts, exact)) and len(got) > 1000


@pytest.mark.parametrize("exact", [True, False])
def test_equals_single_calls(df, exact):
    contexts = ["the null", "red", "null re", "null null", "of the null a", "null"]
    got = {(r.context, r.ngram): r.estfrequency for r in context_ngrams(df, contexts, exact=exact).collect()}
    alone = {(c, r.ngram): r.estfrequency for c in contexts for r in context_ngram(df, c, exact=exact).collect()}
    assert got == alone and len(got) > 20


def test_no_contexts_are_an_error(df):
    with pytest.raises(ValueError):
        context_ngrams(df, [])
    with pytest.raises(ValueError):
        context_ngrams(df, [""])
