import functools
import hashlib
import random

import pytest
import sentencepiece
from llm_cases import SF
from sentencepiece import sentencepiece_model_pb2

from tessera.llm import pieces
from tessera.llm.queries import op12_sentencepiece

ALPHABET = ["a", "b", " ", "  ", pieces.SPACE, "é", "😀", "\n", "\t", "\0", "<s>", "<0x0A>", "the ", "　", " ", "�", "ﬁ",
            "가", "Hello", "é", "①", "Å", "㌀", "​", "ｶﾞ", "が", "."]


rules = functools.cache(pieces.charsmap_rules)


def texts(n, longest, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


def expected(library, text):
    ids = library.encode(text or "")
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))


@pytest.mark.parametrize("rule", ["identity", "nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("dummy", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
def test_normaliser_equals_the_library_with_offsets(rule, dummy, squeeze):
    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=dummy, remove_extra_whitespaces=squeeze,
                                                   escape_whitespaces=True)
    spec = sentencepiece_model_pb2.ModelProto.FromString(theirs.serialized_model_proto()).normalizer_spec
    own = pieces.Normalizer(rules(spec.precompiled_charsmap), dummy, squeeze, False)
    for text in texts(200, 12):
        data, origin = own(text)
        result, offsets = theirs.normalize(text, with_offsets=True)
        starts = [0]
        for c in result:
            starts.append(starts[-1] + len(c.encode()))
        assert data.decode() == result
        assert [len(text.encode()[:origin[s]].decode()) for s in starts] == list(offsets), text


def test_codec_equals_the_library(library, monkeypatch):
    monkeypatch.setattr(pieces, "SLICE", 40)  # so that short texts are cut too
    codec = pieces.Codec(pieces.default_model())
    for text in texts(1500, 60):
        parts, bounds = codec.encode(text)
        ids = [i for p in parts for i in p.tolist()]
        assert ids == library.encode(text)
        assert "".join(codec.decode(parts)) == library.decode(ids)
        if not text:
            continue
        # the spans tile the text, and each but the dummy blank holds the piece's own bytes
        assert bounds[0] == 0 and bounds[-1] == len(text.encode())
        for k, (i, a, b) in enumerate(zip(ids, bounds[:-1], bounds[1:], strict=True)):
            own = text.encode()[a:b].replace(b" ", pieces.SPACE.encode())
            name = library.id_to_piece(i)
            if library.is_byte(i):
                assert own == bytes([int(name[3:5], 16)])
            else:
                assert own.decode() == (name[1:] if k == 0 else name)


def test_encode_decode_round_trip(spark, library, odd):
    coded = pieces.encode(odd)
    assert coded.columns == ["doc_id", "ids", "bounds"]
    back = {(r.doc_id, tuple(r.ids)): r.text for r in coded.join(pieces.decode(coded), "doc_id").collect()}
    for r in odd.collect():
        if r.doc_id is not None:
            assert back[(r.doc_id, tuple(library.encode(r.text or "")))] == (r.text or "")


def test_digest_of_odd_rows(library, odd, none):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.digest(odd).collect())
    assert got == sorted((r.doc_id is None, r.doc_id or 0, *expected(library, r.text)) for r in odd.collect())
    assert all(r.spans_tile for r in pieces.digest(odd).collect())
    assert pieces.digest(none).count() == 0


def test_very_long_texts(spark, library):
    rows = [(1, " " * 300_000), (2, "x" * 30_000), (3, "ab " * 200_000), (4, "\t\n" * 100_000)]
    for r in pieces.digest(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(library, dict(rows)[r.doc_id])


def test_the_query_on_the_whole_table(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op12_sentencepiece(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(library, docs[r.doc_id]) and r.spans_tile
