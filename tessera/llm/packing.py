"""Packing documents into token sequences (operator 10).

A document's ids are cut into full windows of ``capacity`` ids and one shorter
rest.  Full windows are sequences as they are.  The rest is cut into pieces of
at most PIECE ids (several fit a window, so sums can be made near-equal); they
are dealt into buckets of about BUCKET pieces, and in each bucket Karmarkar-Karp multiway
differencing spreads them over as few windows as their sum allows: every piece
starts as a partial partition of its own, the two partitions with the largest
imbalance are merged with opposing order (largest with smallest), and so on to
the last.  If its fullest window exceeds the capacity, the number of windows
rises by one and the bucket is differenced again.

Only piece lengths meet in a bucket; ids never leave the task that made them.

Defined cases: a null or empty text is the closing id alone; repeated rows are
packed each on its own; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import chunks, in_small_batches, persisted

#: Ids in a sequence, most ids in a piece of a rest, and pieces in a bucket.
CAPACITY, PIECE, BUCKET = 2048, 1024, 512
END_ID = 1
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Characters of a text from which on the tokenizer's own, slower library encodes it: the
#: other one fails on white space of a million characters in a row.
LONG = 500_000


def bpe_encoder(vocabulary: str = VOCABULARY) -> Callable[[str], list[int]]:
    """Encoder over a public byte-level BPE vocabulary.  ``vocabulary`` names
    a file of merge ranks; its ids are those of the tokenizer file of the same
    name (the tests compare the two).  Texts are cut at the added tokens of that
    file, as it does itself; texts longer than LONG are encoded by it."""
    import base64
    import json

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    file = public_tokenizers.path(vocabulary.rsplit(".", 1)[0] + ".json")
    with open(file, encoding="utf-8") as f:
        added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    own = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks={k: v for k, v in ranks.items() if k.decode(
        "utf-8", "replace") not in added}, special_tokens=added)
    slow = None

    def encode(text: str) -> list[int]:
        nonlocal slow
        if len(text) <= LONG:
            return own.encode(text, allowed_special="all")
        if slow is None:
            from tokenizers import Tokenizer

            slow = Tokenizer.from_file(file)
        return slow.encode(text, add_special_tokens=False).ids

    return encode


def pieces(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", capacity: int = CAPACITY, piece: int = PIECE,
           encoder: Callable[[], Callable[[str], list[int]]] = bpe_encoder) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens): full windows first, then the pieces of the rest."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder()
        for batch in batches:
            for part in chunks(batch, 500):
                out = []
                for i, text in zip(part["id"], part["t"], strict=True):
                    ids = np.array([*encode(text or ""), END_ID], dtype="<u4")
                    full = len(ids) // capacity * capacity
                    cuts = [*range(0, full, capacity), *range(full, len(ids), piece), len(ids)]
                    out += [(i, a, b - a, zlib.crc32(ids[a:b].tobytes()), len(ids)) for a, b in pairwise(cuts)]
                yield pd.DataFrame(out, columns=["id", "start", "length", "ids_crc32", "doc_tokens"]).astype(
                    {"id": "Int64"} if kind == "bigint" else {})

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return in_small_batches(slim).mapInPandas(run, f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def difference(lengths: list[int], windows: int) -> np.ndarray:
    """Karmarkar-Karp: the window (0 .. windows - 1) of each item, sums near-equal."""
    n = len(lengths)
    up, fresh = np.full(2 * n * 2, -1, np.int64), n  # a merge of two filled parts makes a node above both
    heap: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    for i, size in enumerate(lengths):
        sums, node = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
        sums[-1], node[-1] = size, i
        heap.append((-size, i, sums, node))
    heapq.heapify(heap)
    tie = n
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)  # sums ascend
        _, _, b, y = heapq.heappop(heap)
        sums, y = a + b[::-1], y[::-1]
        node = np.maximum(x, y)
        both = np.flatnonzero((x >= 0) & (y >= 0))
        if len(both):
            made = np.arange(fresh, fresh + len(both))
            up[x[both]] = up[y[both]] = node[both] = made
            fresh += len(both)
        order = np.argsort(sums, kind="stable")
        sums = sums[order]
        heapq.heappush(heap, (int(sums[0] - sums[-1]), tie, sums, node[order]))
        tie += 1
    part = np.full(fresh, -1, np.int64)
    if heap:
        filled = heap[0][3] >= 0
        part[heap[0][3][filled]] = np.flatnonzero(filled)
    for v in range(fresh - 1, -1, -1):  # a node's number is above its children's
        if up[v] >= 0:
            part[v] = part[up[v]]
    return part[:n]


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> np.ndarray:
    """The window of each piece, none above ``capacity`` in sum; as few as differencing fits."""
    size, most = np.array(lengths, np.int64), len(lengths)
    windows = max(1, -(-int(size.sum()) // capacity))
    while windows < most:
        part = difference(lengths, windows)
        if np.bincount(part, size).max() <= capacity:
            return part
        windows += 1
    return np.arange(most)


def pack(docs: DataFrame, *, capacity: int = CAPACITY, bucket: int = BUCKET, **options) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    # the row number is written once, so that a lost executor cannot renumber what others have read
    cut = persisted(pieces(docs, capacity=capacity, **options).withColumn("n", F.monotonically_increasing_id()), "pieces")
    full = F.col("length") == capacity
    buckets = max(1, -(-cut.filter(~full).count() // bucket))
    rests = cut.filter(~full).withColumn("bucket", F.pmod(F.xxhash64("n"), F.lit(buckets)))

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("n").reset_index(drop=True)
        lengths = frame["length"].tolist()
        number = pack_lengths(lengths, capacity)
        offset = frame["length"].groupby(number).cumsum() - frame["length"]
        # even numbers; at most one window a piece, so buckets cannot meet
        first = (int(frame["bucket"].iloc[0]) << 33) if len(frame) else 0
        return frame[["n"]].assign(sequence_id=first + 2 * number, offset=offset)

    dealt = (rests.select("n", "length", "bucket").groupBy("bucket")
             .applyInPandas(solve, "n bigint, sequence_id bigint, offset bigint"))
    keep = ["id", "start", "length", "ids_crc32", "doc_tokens"]
    alone = cut.filter(full).select(*keep, (F.col("n") * 2 + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    # a row a piece, which takes seven times its file in a broadcast: planned at every size as the shuffle that it is at scale
    return (rests.join(dealt.hint("merge"), "n").select(*keep, "sequence_id", "offset").unionByName(alone)
            .withColumnRenamed("id", "doc_id"))
