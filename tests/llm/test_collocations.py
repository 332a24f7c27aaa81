import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import DOCS, SF

from tessera.llm import collocations
from tessera.llm.queries import op13_collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def phrases_of(text, longest=4):
    for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
        words = [w for w in re.split("[ \t]+", piece) if w]
        for n in range(1, longest + 1):
            for i in range(len(words) - n + 1):
                yield tuple(words[i:i + n])


def brute(rows, threshold, top):
    f = defaultdict(Counter)
    for lang, text in rows:
        f[lang or "und"].update(phrases_of(text))
    out = []
    for lang, counts in f.items():
        frequent = {p: c for p, c in counts.items() if len(p) > 1 and c >= threshold}
        above = Counter()
        for p, c in frequent.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    above[p[i:i + m]] = max(above[p[i:i + m]], c)
        scored = []
        for p, a in frequent.items():
            if 100 * above[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        n = sum(c for p, c in counts.items() if len(p) == 1)
        out += [(lang, i, p.decode(), -a, left, r, n, -s) for i, (s, a, p, left, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def repetitive(rng, n):
    words = ["a", "B", "é", "new", "york", "City", "of", "x1", "\x1f", "日本"]
    joins = [" ", " ", " ", " ", "  ", "\t", ", ", "!", "\n", "\x0b"]
    return ["".join(rng.choice(words[:rng.randint(2, 10)]) + rng.choice(joins) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def result(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in df.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("shards, bits, top", [(1, 1 << 20, 50), (3, 1 << 20, 2000), (4, 1 << 6, 2000)])
def test_equals_brute_force(spark, shards, bits, top):
    """Also with a bitmap so small that bits are shared by many phrases."""
    rng = random.Random(shards)
    rows = [(rng.choice(["en", "en", "de", None, "und"]), t) for t in repetitive(rng, 150)] + [("en", None), (None, ""), ("xx", "lone")]
    df = spark.createDataFrame([(i, t, lang, "s", 1) for i, (lang, t) in enumerate(rows)], DOCS).repartition(6)
    got = result(collocations.collocations(df, threshold=8, top=top, shards=shards, bits=bits))
    assert got == brute(rows, 8, top) and len(got) > 60


def test_one_phrase_in_most_rows(spark):
    rows = [("en", "to be or not to be")] * 400 + [("en", "to be, or not")] * 70
    df = spark.createDataFrame([(i, t, lang, "s", 1) for i, (lang, t) in enumerate(rows)], DOCS).repartition(8)
    assert result(collocations.collocations(df)) == brute(rows, 30, 2000)


def test_stretches_and_places_of_a_task(monkeypatch):
    texts = repetitive(random.Random(9), 80)
    every = np.full(1 << 7, 255, np.uint8)
    whole = Counter(p for t in texts for p in phrases_of(t))
    monkeypatch.setattr(collocations, "STRETCH", 500)
    monkeypatch.setattr(collocations, "BLOCK", 100)
    parts = list(collocations.stretches([t.encode() for t in texts]))
    assert len(parts) > 5
    got, names = Counter(), {}
    for data in parts:
        for n, start, end, x, y, old in collocations.runs(data, zlib.crc32(b"en"), every):
            first, times = collocations.distinct(x, y)
            assert times.sum() == len(x) and not old.any()
            for i, c in zip(first, times, strict=True):
                key, phrase = (int(x[i]), int(y[i])), tuple(re.split(" +", data[start[i]:end[i]].decode()))
                assert len(phrase) == n and names.setdefault(key, phrase) == phrase
                got[phrase] += int(c)
    assert got == whole and len(names) == len(whole)
    # what passed a round ago is told apart
    for n, *_, old in collocations.runs(parts[0], 1, every, every):
        assert n == 1 or old.all()


def test_odd_and_empty_tables(spark, odd, odd_rows, none):
    assert collocations.collocations(none).count() == 0
    assert result(collocations.collocations(odd)) == brute([(r[2], r[1]) for r in odd_rows], 30, 2000)


def test_the_query_on_the_whole_table(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(op13_collocations(spark, SF)) == brute(rows, 30, 2000)
