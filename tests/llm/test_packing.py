import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tessera.llm import packing as P
from tessera.llm.common import read_table

from llm_cases import SF


TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def reference_ids(texts):
    return [[*e.ids, 1] for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]


def check(out, texts_by_id, capacity=P.CAPACITY):
    """Every id in one piece, sequences gapless and within capacity; returns their fill."""
    ids = {k: [reference_ids([t or ""])[0] for t in v] for k, v in texts_by_id.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for k, copies in ids.items():
        assert sorted({r["doc_tokens"] for r in pieces[k]}) == sorted({len(c) for c in copies})
        assert sum(r["length"] for r in pieces[k]) == sum(map(len, copies))
        for r in pieces[k]:
            assert any(zlib.crc32(np.array(c[r["start"]:r["start"] + r["length"]], dtype="<u4").tobytes()) == r["ids_crc32"] for c in copies)
            assert 0 < r["length"] and r["start"] + r["length"] <= r["doc_tokens"]
        at = sorted((r["start"], r["length"]) for r in pieces[k])
        assert len(copies) > 1 or all(a + n == b for (a, n), (b, _) in zip(at, at[1:], strict=False))
    for rows in sequences.values():
        rows.sort(key=lambda r: r["offset"])
        assert rows[0]["offset"] == 0 and all(a["offset"] + a["length"] == b["offset"] for a, b in zip(rows, rows[1:], strict=False))
        assert sum(r["length"] for r in rows) <= capacity
    return sum(r["length"] for r in out) / (capacity * len(sequences))


def test_documents_are_packed(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r["doc_id"]: [r["text"]] for r in docs.collect()}
    assert check(P.pack(docs).collect(), texts) >= 0.96


def test_encoder_equals_the_tokenizer():
    import duckdb
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()]
    rng = random.Random(1)
    texts += ["".join(chr(rng.choice([10, 32, 32, 97, 98, 233, 0x4E2D, 0x1F600, 39, 48, 0xA0])) for _ in range(200)) for _ in range(50)]
    encode = P.bpe_encoder()
    assert [[*encode(t), 1] for t in texts] == reference_ids(texts)


def test_differencing():
    rng = random.Random(2)
    for n, k in ((1, 1), (5, 2), (40, 7), (300, 60)):
        sizes = [rng.randint(1, 1024) for _ in range(n)]
        part = P.difference(sizes, k)
        sums = np.bincount(part, sizes, minlength=k)
        assert len(part) == n and part.min() >= 0 and part.max() < k and sums.sum() == sum(sizes)
        assert n < 40 or sums.max() - sums.min() <= max(sizes) / 4
        packed = P.pack_lengths(sizes, 1024)
        assert np.bincount(packed, sizes).max() <= 1024
    assert sorted(np.bincount(P.difference([8, 7, 6, 5, 4], 2), [8, 7, 6, 5, 4])) == [14, 16]  # the textbook case
    assert P.pack_lengths([1024] * 3, 1024).tolist() in ([0, 1, 2], [2, 1, 0]) and len(P.difference([], 3)) == 0


def test_defined_cases(spark, odd, odd_rows, none):
    assert P.pack(none).collect() == []
    texts = defaultdict(list)
    for r in odd_rows:
        texts[r[0]].append(r[1])
    out = P.pack(odd).collect()
    check(out, texts)
    assert [(r["length"], r["doc_tokens"]) for r in out if r["doc_id"] in (1, 2)] == [(1, 1)] * 2


def test_added_tokens_inside_texts():
    end = "<|endoftext|>"
    texts = [f"end of page {end} next page", end, f"{end}{end}", f"a {end}b", f"{end} \n{end}  ", "<|endoftext |>", f"<|endof{end}text|>", f"'s{end}'s"]
    encode = P.bpe_encoder()
    assert [[*encode(t), 1] for t in texts] == reference_ids(texts)
    assert 50256 in encode(texts[0])


def test_very_long_white_space():
    """Runs on which the fast encoder fails get the tokenizer's own ids."""
    encode = P.bpe_encoder()
    for unit in (" ", "\t", "\n", "\r\n", "a "):
        text = "x" + unit * 1_000_000 + "y"
        assert [*encode(text), 1] == reference_ids([text])[0]


def test_pieces_are_not_broadcast(spark, odd):
    assert "BroadcastHashJoin" not in P.pack(odd)._jdf.queryExecution().executedPlan().toString()
