import random

import numpy as np
import pytest

from tessera.llm import ann
from tessera.llm.common import read_table

VECTORS = "vec_id bigint, embedding array<float>, label int"


def exact(rows, every, k):
    ids = sorted(rows)
    m = np.array([rows[i] for i in ids], dtype=np.float32).astype(float)
    out = {}
    for n, i in enumerate(ids):
        if i % every == 0:
            s = ann.inner(np.repeat(m[n:n + 1], len(m), axis=0), m)
            out[i] = [(ids[j], s[j]) for j in sorted((j for j in range(len(ids)) if j != n), key=lambda j: (-s[j], ids[j]))[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(map(tuple, df.collect())):
        out.setdefault(r[0], []).append((r[2], r[3]))
        assert r[1] == len(out[r[0]])
    return out


def test_recall_on_the_given_table(spark):
    df = read_table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = {r["vec_id"]: r["embedding"] for r in df.collect()}
    want, got = exact(rows, ann.EVERY, ann.K), found(ann.search(df, sample=1500))
    assert set(want) == set(got) and all(len(v) == ann.K for v in got.values())
    recall = np.mean([len({i for i, _ in want[q]} & {i for i, _ in got[q]}) / ann.K for q in want])
    assert recall >= 0.9
    assert all(dict(want[q]).get(i, s) == s for q in got for i, s in got[q])


def test_copies_of_one_vector_in_chunks(spark):
    """A leaf of equal vectors is cut into chunks; all ties are there."""
    rng = random.Random(2)
    rows = {i: [rng.gauss(0, 1) for _ in range(6)] for i in range(300)}
    rows |= {i: [1.0, 2.0, 3.0, 0.5, 0.25, 1.5] for i in range(300, 700)}
    df = spark.createDataFrame([(i, v, 0) for i, v in rows.items()], VECTORS)
    got = found(ann.search(df, chunk=50, sample=200))
    want = exact(rows, ann.EVERY, ann.K)
    hot = [q for q in want if q >= 300]
    assert hot and all(got[q] == want[q] for q in hot)


def test_defined_cases(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [0.9, 0.1]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]),
            (5, [None, 1.0]), (6, [1.0, 2.0, 3.0]), (40, []), (60, [2.0, 2.0, 2.0]), (1, [0.9, 0.1]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).selectExpr("*", "1 AS id", "2 AS v", "3 AS leaf")
    got = found(ann.search(df))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [1, 20], 20: [0, 1], 60: [6]}
    assert ann.search(df.limit(0)).collect() == []
    one = spark.createDataFrame([(0, [1.0], 0)], VECTORS)
    assert ann.search(one).collect() == []


def test_every_query_gets_k_rows(spark):
    """Also where the sample is the whole table and the forest misses some of the nearest."""
    df = read_table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = {r["vec_id"]: r["embedding"] for r in df.collect()}
    for options in ({}, {"recall": 0.5}):
        want, got = exact(rows, ann.EVERY, ann.K), found(ann.search(df, **options))
        assert set(want) == set(got) and all(len(v) == ann.K for v in got.values())
    assert any({i for i, _ in want[q]} != {i for i, _ in got[q]} for q in want)


@pytest.mark.parametrize("scale", [1e-8, 1.0, 1e4, 1e8])
def test_scale_and_length_of_vectors_do_not_matter(spark, scale):
    """Every query gets k rows, also from vectors of two lengths in one table."""
    rng = np.random.default_rng(int(abs(np.log10(scale))))
    rows = {i: (rng.standard_normal(64 if i % 3 else 24) * scale).tolist() for i in range(900)}
    df = spark.createDataFrame([(i, v, 0) for i, v in rows.items()], "vec_id bigint, embedding array<double>, label int")
    got = found(ann.search(df))
    for q in range(0, 900, ann.EVERY):
        near = sorted(((float(np.dot(rows[q], v)), -i) for i, v in rows.items() if i != q and len(v) == len(rows[q])), reverse=True)
        assert len(got[q]) == ann.K
        assert len({-i for _, i in near[:ann.K]} & {i for i, _ in got[q]}) >= 0.6 * ann.K
