import hashlib
import random
from collections import Counter

import pytest

from tessera.llm import suffix_dedup as S
from tessera.llm.common import text_bytes

from llm_cases import DOCS, prose


def brute(texts: list[bytes], length: int) -> list[tuple[int, int, int, str]]:
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


def digests(df) -> dict:
    return {r["doc_id"]: tuple(r)[1:] for r in df.collect()}


def texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    out = [base, base[:1500] + "X" + base[1501:], base[100:900] + prose(rng, 60), prose(rng, 300), "a" * 1500,
           "ab" * 700 + "c" + "ab" * 300, "short", "", base[50:450], base[777:1176], "é" * 500, "xé" * 300, "yé" * 300]
    for _ in range(8):
        changed = list(base)
        for _ in range(6):
            changed[rng.randrange(3000)] = "Z"
        out.append("".join(changed))
    return out


@pytest.mark.parametrize("bucket", [S.BUCKET, 1])
def test_equals_brute_force(spark, bucket):
    """Also where every centre counts as large and its windows are aggregated one by one."""
    t = texts(5)
    df = spark.createDataFrame([(i, x, None, None, None) for i, x in enumerate(t)], DOCS).repartition(3, "doc_id")
    df = spark.createDataFrame(df.collect(), DOCS)
    got = digests(S.digest(df, bucket=bucket))
    want = brute([x.encode() for x in t], S.LENGTH)
    assert [got[i] for i in range(len(t))] == want


def test_every_window_is_recorded_once():
    data = [x.encode() for x in texts(9)]
    ends = [sum(map(len, data[:i + 1])) for i in range(len(data))]
    for length in (S.LENGTH, 200):
        found = [[] for _ in data]
        for text, t, b, lo, hi in S.records(b"".join(data), ends, length).tolist():
            found[text] += [t - a for a in range(lo, hi + 1)]
            assert lo // S.BLOCK == hi // S.BLOCK == b
        for x, end, starts in zip(data, ends, found, strict=True):
            assert sorted(starts) == list(range(end - len(x), end - length + 1))


def test_defined_cases(spark, odd, odd_rows, none):
    assert S.digest(none).collect() == []
    got = sorted(map(tuple, S.digest(odd).collect()), key=repr)
    want = [(r[0], *d) for r, d in zip(odd_rows, brute([text_bytes(r[1]) for r in odd_rows], S.LENGTH), strict=True)]
    assert got == sorted(want, key=repr)


def test_texts_keep_whole_characters(spark):
    shared = "".join(random.Random(1).choice("éüß€") for _ in range(400))
    df = spark.createDataFrame([(1, "a" + shared + "€b", "en", "s", 9), (2, "ü" + shared + "ß", "en", "s", 9), (3, None, "en", "s", 7)], DOCS)
    out = {r["doc_id"]: r for r in S.deduplicated(df).collect()}
    assert S.deduplicated(df).columns == df.columns
    assert out[1]["text"].startswith("a") and out[1]["text"].endswith("b") and out[1]["n_chars"] == len(out[1]["text"]) < 10
    assert out[3]["text"] is None and out[3]["n_chars"] == 7
