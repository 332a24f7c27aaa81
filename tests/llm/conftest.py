import os
import random

import pytest
from llm_cases import DOCS, prose

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    env = spark.sparkContext.environment
    env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls everywhere, empty, blank and very long texts, equal texts, a repeated row, an id twice."""
    rng = random.Random(3)
    long, same = prose(rng, 20_000), prose(rng, 120)
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4), (4, long, "en", "b", len(long)),
            (5, same, "en", None, 9), (6, same, "de", "b", 9), (6, same, "de", "b", 9), (7, "x" * 5000, "fr", "c", 5000),
            (8, same + " tail", "en", "a", 1), (9, "Ünïcödé € 😀 " * 60, "xx", "b", 1), (10, "one", "en", "c", 3),
            (11, prose(rng, 300), "en", "c", 1), (None, prose(rng, 40), "en", "a", 1), (None, same, None, "a", 1),
            (12, "a b " * 400, "en", "b", 1)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows with extra columns whose names clash with those that operators use inside."""
    names = ("row", "t", "key", "size", "id", "_row", "names", "language", "spans", "hits", "doc", "times", "fp", "h", "v")
    df = spark.createDataFrame(odd_rows, DOCS)
    return df.selectExpr("*", *[f"'{n}' AS `{n}`" for n in names])


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
