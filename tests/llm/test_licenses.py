import random
import re

from tessera.llm import licenses as L
from tessera.llm.common import read_table

from llm_cases import DOCS, SF, prose


def words(text):
    return re.sub("[^a-z0-9]+", " ", (text or "").lower()).split()


def brute(rows, templates):
    """Documents some stretch of which (as long as a window's surroundings) holds enough of a template."""
    sets = {k: (len(words(t)), {tuple(words(t)[i:i + 5]) for i in range(len(words(t)) - 4)}) for k, t in templates.items()}
    out = set()
    for i, text in rows:
        x = words(text)
        runs = [tuple(x[j:j + 5]) for j in range(len(x) - 4)]
        for name, (n, wanted) in sets.items():
            hits = [j for j, s in enumerate(runs) if s in wanted]
            if any(len({runs[m] for m in hits if j <= m < j + n + L.WINDOW}) >= L.CONTAINED * len(wanted) for j in hits):
                out.add((i, name))
    return out


def test_finds_what_brute_force_finds(spark):
    docs = read_table(spark, SF, "documents")
    rng = random.Random(1)
    planted = []
    for n, (name, text) in enumerate(L.TEMPLATES.items()):
        own = text.split()
        planted.append((10_000 + n, f"{prose(rng, 200)}\n{text.upper()}\n{prose(rng, 50)}"))
        if len(own) > 15:  # one word changed in the last tenth, and cut off early
            planted.append((20_000 + n, " ".join([prose(rng, 33), *own[:-1], "other", prose(rng, 9)])))
            planted.append((30_000 + n, " ".join(own[:len(own) // 2])))
    more = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in planted], DOCS)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + planted
    got = {(r["doc_id"], r["license"]) for r in L.scan(docs.select(more.columns).union(more)).collect()}
    want = brute(rows, L.TEMPLATES)
    assert got <= want and len(want - got) <= 0.01 * len(want)
    assert {(10_000 + n, name) for n, name in enumerate(L.TEMPLATES)} <= got


def test_defined_cases(spark, odd, none):
    assert L.scan(none).collect() == [] and L.scan(odd).collect() == []
    twice = "Released under the MIT License. " * 2
    df = spark.createDataFrame([(1, twice, None, None, None)] * 2, DOCS).selectExpr("*", "1 AS row", "2 AS words", "3 AS at", "4 AS license")
    got = L.scan(df).collect()
    assert [tuple(r) for r in got] == [(1, "mit", 1.0, 0)] * 2
    assert L.scan(df, templates={"own": "released under the mit license and more words follow here"}).collect() == []
    assert L.scan(df, templates={}).collect() == []


def test_no_python_in_the_plan(spark):
    plan = L.scan(read_table(spark, SF, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "CartesianProduct" not in plan and "NestedLoop" not in plan
