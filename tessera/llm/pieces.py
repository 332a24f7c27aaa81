"""SentencePiece encoding and decoding with byte spans (operator 12).

1. Normalisation: at every place of the text the longest source string of the
   model's compiled character map is replaced (a character without a rule
   stays), blanks become the piece alphabet's space mark, and every byte of
   the result keeps the offset of the source byte it comes from.
2. Encoding: no piece of the vocabulary continues past a space mark that
   follows another character (checked when the model is loaded), so merges
   never cross such a place.  A long text is cut there into slices, which
   bounds the work of the merges; the public library encodes them, over the
   model without its normaliser.
3. Projection: the pieces' lengths, summed up, are places in the normalised
   text; their source offsets are the pieces' spans, which tile the text.
4. Decoding is the library's own.

Texts are independent, so one pass over the table does it all and nothing is
shuffled.  A task holds one batch and the normalised form of one text.

Defined cases: a null or empty text has no tokens, an empty decoded text and
no spans; repeated rows are encoded each on its own; an empty table gives an
empty result; extra columns are ignored, whatever their names; characters
outside the vocabulary become byte pieces, whose spans are single bytes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import chunks, in_small_batches

MODEL = "piece_bpe_32k.model"
#: Characters of a normalised text that are encoded at a time.
SLICE = 1 << 18
SPACE = "▁"
_MARK = SPACE.encode()
_CUT = re.compile(f"(?<=[^{SPACE}]){SPACE}")


def charsmap_rules(blob: bytes) -> dict[str, str]:
    """Source string -> replacement, from a compiled character map: its size,
    a double-array trie of 32-bit units over the source bytes, and the
    replacements, each ended by a zero byte."""
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units, text = np.frombuffer(blob, "<u4", size // 4, 4).tolist(), blob[4 + size:]

    def child(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    rules, stack = {}, [(child(units[0]), b"")]
    while stack:
        base, source = stack.pop()
        for byte in range(1, 256):
            at = base ^ byte
            if at >= len(units) or units[at] & 0x800000FF != byte:
                continue
            below = at ^ child(units[at])
            if units[at] & 256:
                start = units[below] & 0x7FFFFFFF
                rules[(source + bytes([byte])).decode()] = text[start:text.index(b"\0", start)].decode()
            stack.append((below, source + bytes([byte])))
    return rules


@dataclass
class Normalizer:
    """A model's normalisation, with the source byte of every byte it makes."""

    rules: dict[str, str]
    dummy_prefix: bool
    squeeze: bool  # blanks at the ends go, and of a run of blanks one stays
    suffix: bool   # the space mark closes a word instead of opening it

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.rules), default=0)
        firsts = {re.escape(k[0]) for k in self.rules}
        self.first = re.compile(f"[{''.join(sorted(firsts))}]") if firsts else None

    def replaced(self, text: str) -> Iterator[tuple[str, str]]:
        """(result, source) of each replacement and of each untouched stretch between them, in order."""
        at = stretch = 0
        while self.first and (hit := self.first.search(text, at)):
            i = hit.start()
            n = next((n for n in range(min(self.longest, len(text) - i), 0, -1) if text[i:i + n] in self.rules), 0)
            if n:
                yield text[stretch:i], text[stretch:i]
                yield self.rules[text[i:i + n]], text[i:i + n]
                stretch = i + n
            at = i + max(n, 1)
        yield text[stretch:], text[stretch:]

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes the offset of the
        source byte that it comes from; one offset more says where it ends."""
        at, made, origin = 0, [], []
        for result, source in self.replaced(text):
            data, size = result.encode(), len(source.encode())
            made.append(data)
            origin.append(np.full(len(data), at) if result != source else np.arange(at, at + size))
            at += size
        return self.spaced(np.frombuffer(b"".join(made), np.uint8), np.concatenate([*origin, [at]]).astype(np.int64))

    def spaced(self, data: np.ndarray, origin: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Blanks become space marks (of three bytes), after the model's rules on needless ones."""
        blank = data == 32
        if self.squeeze:
            kept = ~(blank & np.concatenate([[True], blank[:-1]]))
            data, blank, origin = data[kept], blank[kept], origin[np.append(kept, True)]
        if not len(data):
            return b"", np.zeros(1, np.int64)
        out, end = data.tobytes().replace(b" ", _MARK), origin[-1:]
        places = np.repeat(origin[:-1], np.where(blank, len(_MARK), 1))
        if self.dummy_prefix and not self.suffix:
            out, places = _MARK + out, np.concatenate([np.repeat(origin[:1] * self.squeeze, len(_MARK)), places])
        while self.squeeze and out.endswith(_MARK):
            out, places, end = out[:-len(_MARK)], places[:-len(_MARK)], places[-len(_MARK):][:1]
        if self.dummy_prefix and self.suffix:
            out, places = out + _MARK, np.concatenate([places, np.repeat(end, len(_MARK))])
        return out, np.concatenate([places, end])


class Codec:
    """A model's encoder and decoder in one task."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            blob = f.read()
        spec = sentencepiece_model_pb2.ModelProto.FromString(blob)
        kinds = spec.SentencePiece
        if spec.trainer_spec.model_type != spec.trainer_spec.BPE or not spec.trainer_spec.byte_fallback:
            raise ValueError("a BPE model with byte pieces is needed")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) or _CUT.search(p.piece) for p in spec.pieces):
            raise ValueError("a piece of the model can reach over the start of a word")
        rule = spec.normalizer_spec
        if not rule.escape_whitespaces:
            raise ValueError("a model that marks spaces is needed")
        self.normalize = Normalizer(charsmap_rules(rule.precompiled_charsmap), rule.add_dummy_prefix, rule.remove_extra_whitespaces,
                                    spec.trainer_spec.treat_whitespace_as_suffix)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.sizes = np.array([1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in spec.pieces], np.int64)
        rule.Clear()
        rule.name, rule.add_dummy_prefix, rule.remove_extra_whitespaces = "identity", False, False
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())  # for text that is normalised
        self.mark = self.library.piece_to_id(SPACE)

    def encode(self, text: str) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids, a slice of the text at a time, and the source offsets at which their pieces begin (one more: where the last ends)."""
        data, origin = self.normalize(text)
        whole, at, out = data.decode(), 0, []
        while at < len(whole):
            cut = _CUT.search(whole, at + SLICE)
            end = cut.start() if cut else len(whole)
            out.append(np.asarray(self.plain.encode(whole[at:end], return_type="numpy"), np.int32))
            at = end
        bounds = np.cumsum(np.concatenate([[0], *[self.sizes[i] for i in out]]))
        return out, origin[bounds]

    def decode(self, parts: list[np.ndarray]) -> Iterator[str]:
        """The text of the ids, a slice at a time; the library drops the first blank of what it is given, so later slices bring one."""
        for n, part in enumerate(parts):
            yield self.library.decode(part.tolist() if n == 0 else [self.mark, *part.tolist()])


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def _mapped(docs: DataFrame, text_col: str, id_col: str, model: str | None, schema: str, columns: list[str], row) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(model or default_model())
        for batch in batches:
            for part in chunks(batch, 100):
                out = [(i, *row(codec, text or "")) for i, text in zip(part["id"], part["t"], strict=True)]
                yield pd.DataFrame(out, columns=["id", *columns]).astype({"id": "Int64"} if kind == "bigint" else {})

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return in_small_batches(slim).mapInPandas(run, f"id {kind}, {schema}").withColumnRenamed("id", id_col)


def encode(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", model: str | None = None) -> DataFrame:
    """(id, ids, bounds): the pieces of every text; piece i stands for the
    UTF-8 bytes from bounds[i] up to bounds[i + 1] of the original text."""
    def row(codec: Codec, text: str) -> tuple:
        ids, bounds = codec.encode(text)
        return np.concatenate([np.empty(0, np.int32), *ids]), bounds if ids else bounds[:0]

    return _mapped(docs, text_col, id_col, model, "ids array<int>, bounds array<bigint>", ["ids", "bounds"], row)


def decode(coded: DataFrame, *, ids_col: str = "ids", id_col: str = "doc_id", model: str | None = None) -> DataFrame:
    """(id, text): the library's decoding of every row's ids."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(model or default_model())
        for batch in batches:
            texts = [None if ids is None else codec.library.decode([int(i) for i in ids]) for ids in batch["ids"]]
            yield batch[["id"]].assign(text=texts)

    kind = coded.schema[id_col].dataType.simpleString()
    slim = coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return in_small_batches(slim).mapInPandas(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def digest(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", model: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and spans_tile: whether the
    pieces' spans follow each other from the text's first byte to its last.
    The same encoding and decoding as ``encode`` and ``decode``, of which only
    the digests leave the task."""
    def row(codec: Codec, text: str) -> tuple:
        parts, bounds = codec.encode(text)
        coded, plain, n = hashlib.sha256(), hashlib.sha256(), 0
        for part, decoded in zip(parts, codec.decode(parts), strict=True):
            if n:
                coded.update(b",")
            coded.update(repr(part.tolist())[1:-1].replace(" ", "").encode())
            plain.update(decoded.encode())
            n += len(part)
        tiled = bool(bounds[0] == 0 and bounds[-1] == len(text.encode()) and (np.diff(bounds) >= 0).all()) if n else not text
        return n, coded.hexdigest(), plain.hexdigest(), tiled

    return _mapped(docs, text_col, id_col, model, "n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_tile boolean",
                   ["n_tokens", "ids_sha256", "decoded_sha256", "spans_tile"], row)
