import math
import random

import duckdb

from tessera.llm import exact_topk as E
from tessera.llm.queries import SQL

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            good[i] = min(good.get(i, list(v)), list(v))
    q = {i: [math.floor(1024 * x) for x in v] for i, v in good.items()}
    out = []
    for i in q:
        if i % every == 0:
            s = sorted((-sum(a * b for a, b in zip(q[i], q[j], strict=True)), j) for j in q if j != i and len(q[j]) == len(q[i]))
            out += [(i, r + 1, j, -t) for r, (t, j) in enumerate(s[:k])]
    return sorted(out)


def table(spark, rows):
    import numpy as np
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    return rows, spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)


def test_equals_brute_force_with_ties_and_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(9)]) for i in range(400)]
    rows += [(400 + i, rows[i % 3][1]) for i in range(60)]                       # equal vectors
    rows += [(500, None), (501, []), (502, [1.0] * 8 + [float("nan")]), (503, [None] + [1.0] * 8), (504, [float("inf")] * 9),
             (600, [0.5, 0.25]), (601, [0.5, -0.25]), (None, [0.1] * 9), (7, [-0.9] * 9), (700, [0.0] * 9), (800, [-1.0] * 9)]
    rows, df = table(spark, rows)
    df = df.selectExpr("*", "1 AS id", "'x' AS v", "2 AS q")
    for block in (4096, 3):
        got = sorted(map(tuple, E.search(df, every=50, query_block=block).collect()))
        assert got == brute(rows, 50, E.K)


def test_few_rows_large_values_and_empty(spark):
    rows, df = table(spark, [(0, [3e9, -1.0, 2.0]), (100, [2e9, 1.0, 2.0]), (3, [1.0, 1.0, 1.0])])
    got = sorted(map(tuple, E.search(df).collect()))
    clip = lambda x: max(-2**63, min(2**63 - 1, x))
    assert got == [(*r[:3], clip(r[3])) for r in brute(rows, 100, 10)]
    assert E.search(df.limit(0)).collect() == []


def test_sql_says_the_same(spark):
    from tessera.llm.common import read_table

    from llm_cases import SF
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert sorted(con.execute(SQL["op2_exact_topk"]).fetchall()) == sorted(map(tuple, E.search(read_table(spark, SF, "embeddings")).collect()))
