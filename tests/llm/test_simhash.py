import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash as S
from tessera.llm.common import persisted
from tessera.llm.graph import components

from llm_cases import DOCS, prose


def plain_fingerprint(text) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps: list[int], distance: int = 2) -> list[int]:
    """Position of the first member of each one's component."""
    f, root = np.array(fps, dtype=np.uint64), list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i] ^ f[:i]) <= distance):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(f))]


def partition(labels):
    seen = {}
    return [seen.setdefault(x, i) for i, x in enumerate(labels)]


def test_fingerprints_and_defined_cases(spark, odd, odd_rows, none):
    assert S.near_duplicate_documents(none).collect() == [] and S.one_of_each(none).collect() == []
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in S.near_duplicate_documents(odd).collect()), key=repr)
    fps = [plain_fingerprint(r[1]) for r in odd_rows]
    roots = brute_components(fps)
    low = {}
    for r, k in zip(odd_rows, roots, strict=True):
        low[k] = min([x for x in (low.get(k), r[0]) if x is not None], default=None)
    assert got == sorted(((r[0], f"{f:016x}", low[k]) for r, f, k in zip(odd_rows, fps, roots, strict=True)), key=repr)
    kept = S.one_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == len(set(roots))


def test_native_hash_agrees(spark):
    text = "Straße naïve 東京 tail"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % 2**64 == xxhash.xxh64_intdigest(text.encode(), seed=42)


@pytest.mark.parametrize("bucket", [S.BUCKET, 2])
def test_components_equal_brute_force(spark, bucket):
    """Balls of fingerprints around centres: pairs in small buckets, midpoints in large ones."""
    rng = random.Random(8)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for centre in fps[:3]:
        for _ in range(120):
            x = centre
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            fps.append(x)
    fps = list(dict.fromkeys(fps))
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    found = {r["node"]: r["root"] for r in components(S.links(df, bucket=bucket)).collect()}
    assert partition([found.get(x, x) for x in signed]) == partition(brute_components(fps))


def test_variants_are_not_broadcast(spark, monkeypatch):
    """A small table of fingerprints is 64 times as many variants, which Spark's estimate does not know."""
    plans = []

    def planned(df, name, by=None):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return persisted(df, name, by)

    fps = persisted(spark.range(40).selectExpr("shiftleft(id, 2) AS fp"), "fps")
    monkeypatch.setattr(S, "persisted", planned)
    for bucket in (S.BUCKET, 2):
        plans.append(S.links(fps, bucket=bucket)._jdf.queryExecution().executedPlan().toString())
    assert sum("Generate" in p and "SortMergeJoin" in p for p in plans) == 2  # the variants
    assert not any("BroadcastHashJoin" in p for p in plans)


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 200), (301, 300), (300, 301)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 300: 300, 301: 300}


def test_one_document_of_each_group_stays(spark):
    rng = random.Random(1)
    base = prose(rng, 400)
    rows = [(i, base + (f" {i}" if i % 2 else ""), "en", "s", 1) for i in range(20)] + [(50, prose(rng, 200), "en", "s", 1)]
    kept = sorted(r["doc_id"] for r in S.one_of_each(spark.createDataFrame(rows, DOCS)).collect())
    assert 50 in kept and 0 in kept
    near = S.near_duplicate_documents(spark.createDataFrame(rows, DOCS)).collect()
    assert kept == sorted({r["component_id"] for r in near})
