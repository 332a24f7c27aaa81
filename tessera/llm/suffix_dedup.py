"""Removal of repeated substrings by prefix-free parsing (operator 1).

A byte goes if a string of LENGTH bytes that covers it starts anywhere else in
the corpus.  Such strings ("windows") are compared in the order that a suffix
array of the corpus would give, built from a dictionary and a parse:

1. Parsing.  A position is a trigger if the rolling hash of its 16 bytes says
   so (one in 64).  Triggers cut a text into phrases.  The first trigger t
   inside a window splits it into the end of a phrase (a bytes before t) and
   the phrases from t on, and equal windows are split at the same a.  Windows
   are therefore kept as one record for each trigger and each BLOCK values of
   a: the bytes that all of them share (the centre), those to its left (ends
   of phrases: the dictionary) and those to its right (the parse).
2. A centre that occurs once has no repeated window.  Centres are counted by
   hash, on map sides first, and only records of repeated ones go on.
3. Equal records are counted as one class.  Classes of a centre are brought
   into order: right sides are sorted (the parse's suffix array); left sides
   are refined from the centre outwards, one byte at a time, into the classes
   of equal phrase suffixes (the dictionary's suffix array, read backwards).
   Within one phrase suffix the right sides come in sorted order, as in the
   corpus' suffix array, so a window repeats exactly if it shares its part of
   the right side with the record before or after it.
4. What repeats goes back to the records' documents.

A centre with more than BUCKET classes is not gathered: its windows are grouped
one by one, by hash, with partial sums.  Windows without any trigger, as in
texts that repeat a word, are split at the first of their least hashes
instead, which their bytes determine as well.  Rows are told apart by their place in the input, which
must be a table read (so that reading it twice gives the same places).

Defined cases: null text is empty; texts shorter than LENGTH lose nothing;
repeated rows repeat each other, whatever their ids; an empty table gives an
empty result; extra columns are ignored (``deduplicated`` keeps them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, first_minima, in_small_batches, joined_anew, persisted, release, text_bytes, whole

LENGTH, WIDTH, BLOCK, BUCKET, PARSED_BYTES, ORDERED_ROWS = 400, 16, 64, 2000, 1 << 20, 20_000
_TABLE = np.random.Generator(np.random.PCG64(20)).integers(0, 2**32, 256, dtype=np.uint32)


# ------------------------------------------------------------------ the parse
def rolling_hash(data: bytes) -> np.ndarray:
    """Hash of the WIDTH bytes from each position on (doubling: 1, 2, 4, 8, 16 bytes)."""
    if len(data) < WIDTH:
        return np.empty(0, np.uint32)
    h, power, step = _TABLE[np.frombuffer(data, np.uint8)], 2654435769, 1
    while step < WIDTH:
        h = h[:-step] * np.uint32(power) + h[step:]
        power, step = power * power % 2**32, 2 * step
    h = h ^ (h >> np.uint32(15))
    return h * np.uint32(0x85EBCA6B)


def _covered(starts: np.ndarray, stops: np.ndarray, n: int) -> np.ndarray:
    """Whether each of n positions lies in one of the ranges [start, stop)."""
    return np.cumsum(np.bincount(starts, minlength=n + 1)[:n] - np.bincount(stops, minlength=n + 1)[:n]) > 0


def records(data: bytes, ends: list[int], length: int = LENGTH) -> np.ndarray:
    """(text, t, block, lo, hi) rows over texts that stand one after the other
    in ``data`` and end at ``ends``: windows that start at t - a for a in
    lo..hi, a // BLOCK = block."""
    stop = np.asarray(ends, np.int64)
    start = np.concatenate([[0], stop[:-1]])
    some = stop - start >= length
    if not some.any():
        return np.empty((0, 5), np.int64)
    h = rolling_hash(data)
    t = np.flatnonzero(h >> np.uint32(32 - 6) == 0)
    text = np.searchsorted(stop, t, side="right")
    inside = t + WIDTH <= stop[text]
    t, text = t[inside], text[inside]
    before = np.maximum(np.concatenate([[-1], t[:-1]]), start[text] - 1) if len(t) else t
    lo = np.maximum(0, t + length - stop[text])
    hi = np.minimum(np.minimum(t - before - 1, length - WIDTH), t - start[text])
    used = lo <= hi
    t, text, lo, hi = t[used], text[used], lo[used], hi[used]
    windows = _covered(start[some], stop[some] - length + 1, len(data))
    free = np.flatnonzero(windows & ~_covered(t - hi, t - lo + 1, len(data)))
    if len(free):  # windows without a trigger are split at the first of their least hashes
        at = first_minima(h, length - WIDTH + 1)[free]
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (free[1:] != free[:-1] + 1)]))
        last = np.concatenate([new[1:], [len(free)]]) - 1
        t, text, lo, hi = (np.concatenate(x) for x in (
            (t, at[new]), (text, np.searchsorted(stop, at[new], side="right")), (lo, at[new] - free[last]), (hi, at[new] - free[new])))
    first, end = lo // BLOCK, hi // BLOCK
    many = end - first + 1
    at = np.repeat(np.arange(len(t)), many)
    block = first[at] + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
    return np.stack([text[at], t[at], block, np.maximum(lo[at], block * BLOCK),
                     np.minimum(hi[at], block * BLOCK + BLOCK - 1)], axis=1)


def _parsed(batches: Iterator[pd.DataFrame], length: int) -> Iterator[tuple[pd.DataFrame, bytes, np.ndarray, np.ndarray]]:
    """(rows, their bytes, where each text starts, records), about a megabyte at a time."""
    for batch in batches:
        held, size, first = [], 0, 0
        for i, text in enumerate(batch["t"]):
            held.append(text_bytes(text))
            size += len(held[-1])
            if size >= PARSED_BYTES or i + 1 == len(batch):
                ends = np.cumsum([len(x) for x in held])
                data = b"".join(held)
                yield batch.iloc[first:i + 1], data, np.concatenate([[0], ends[:-1]]), records(data, ends, length)
                held, size, first = [], 0, i + 1


def _centres(rec: np.ndarray) -> list[int]:
    """Where each record's centre starts; it has length - BLOCK + 1 bytes."""
    return (rec[:, 1] - rec[:, 2] * BLOCK).tolist()


def _keys(data: bytes, rec: np.ndarray, length: int) -> np.ndarray:
    digest, inner = xxhash.xxh3_64_intdigest, length - BLOCK + 1
    keys = [digest(data[s:s + inner], b) for s, b in zip(_centres(rec), rec[:, 2].tolist(), strict=True)]
    return np.array(keys, dtype=np.uint64).view(np.int64)


def _places(rec: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A record's name within its text."""
    return (rec[:, 1] - start[rec[:, 0]]) * 256 + rec[:, 2]


def _centre_rows(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, data, start, rec in _parsed(batches, length):
            yield pd.DataFrame({"key": _keys(data, rec, length), "row": rows["row"].to_numpy()[rec[:, 0]], "at": _places(rec, start)})
    return run


def _record_rows(length: int):
    """The records that ``flags`` names, with their sides and a 128-bit class."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest, inner = xxhash.xxh3_128_digest, length - BLOCK + 1
        for rows, data, start, rec in _parsed(batches, length):
            wanted = np.concatenate([np.asarray(f, np.int64) + s * 256 for f, s in zip(rows["flags"], start.tolist(), strict=True)])
            rec = rec[np.isin(rec[:, 1] * 256 + rec[:, 2], wanted)]
            base = rec[:, 2] * BLOCK
            lo, hi = rec[:, 3] - base, rec[:, 4] - base
            cuts = list(zip((rec[:, 1] - rec[:, 4]).tolist(), _centres(rec), (rec[:, 1] + length - rec[:, 3]).tolist(), strict=True))
            heads = [bytes(x) for x in np.stack([rec[:, 2], lo, hi], axis=1).tolist()]
            yield pd.DataFrame({
                "key": _keys(data, rec, length), "class": [digest(x + data[a:c]) for x, (a, _, c) in zip(heads, cuts, strict=True)],
                "left": [data[a:b] for a, b, _ in cuts], "right": [data[b + inner:c] for _, b, c in cuts],
                "lo": lo, "hi": hi, "row": rows["row"].to_numpy()[rec[:, 0]], "at": _places(rec, start)})
    return run


# ------------------------------------------- dictionary and parse in corpus order
def _matrix(sides: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in sides), np.uint8).reshape(-1, width)


def repeated(group: np.ndarray, left: list[bytes], right: list[bytes], lo: np.ndarray, hi: np.ndarray,
             times: np.ndarray) -> np.ndarray:
    """Masks (bit a: the window with a bytes of the left side repeats) of
    distinct records; records of one ``group`` share a centre."""
    n, most = len(group), BLOCK - 1
    mask = np.zeros(n, np.uint64)
    full = [((1 << (h - k + 1)) - 1) << k for k, h in zip(lo.tolist(), hi.tolist(), strict=True)]
    mask[times > 1] = np.array([full[i] for i in np.flatnonzero(times > 1)], np.uint64)
    ends = _matrix([x[::-1] for x in left], BLOCK)                       # outwards from the centre
    words = np.ascontiguousarray(_matrix(right, BLOCK)).view(">u8").astype(np.uint64)
    order = np.lexsort([*words.T[::-1], group])                         # the parse in order, centre by centre
    part = group[order].astype(np.int64)                                # the phrase suffix that records share so far
    for a in range(BLOCK):
        if not len(order):
            break
        same = part[1:] == part[:-1]
        alone = np.concatenate([[True], ~same]) & np.concatenate([~same, [True]])
        order, part = order[~alone], part[~alone]
        live = (lo[order] <= a) & (hi[order] >= a)
        rows, own = order[live], part[live]
        keep = most - a                                                 # bytes of the right side that the window has
        cut = np.clip(keep - 8 * np.arange(8), 0, 8)
        bits = np.array([(2**64 - 1) ^ (2**(64 - 8 * int(c)) - 1) if c else 0 for c in cut], np.uint64)
        side = words[rows] & bits
        if len(rows):
            next_to = (own[1:] == own[:-1]) & (side[1:] == side[:-1]).all(axis=1)
            hit = np.concatenate([[False], next_to]) | np.concatenate([next_to, [False]])
            mask[rows[hit]] |= np.uint64(1 << a)
        longer = hi[order] > a
        order, part = order[longer], part[longer]
        part = part * 256 + ends[order, a]
        again = np.argsort(part, kind="stable")
        order, part = order[again], part[again]
        if len(part):
            part = np.cumsum(np.concatenate([[0], (part[1:] != part[:-1]).astype(np.int64)]))
    return mask


def _order_centres(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by key; a centre's classes (at most BUCKET) are ordered together."""
    def solve(f: pd.DataFrame) -> pd.DataFrame:
        f = f.reset_index(drop=True)
        mask = repeated(pd.factorize(f["key"])[0], list(f["left"]), list(f["right"]), f["lo"].to_numpy(), f["hi"].to_numpy(),
                        f["n"].to_numpy())
        return pd.DataFrame({"class": f["class"], "mask": mask.view(np.int64)})[mask != 0]

    held: list[pd.DataFrame] = []
    for b in batches:
        held.append(b)
        if sum(map(len, held)) >= ORDERED_ROWS:
            f = pd.concat(held)
            last = (f["key"] == f["key"].iloc[-1]).to_numpy()  # the next batch may hold more of it
            held = [f[last]]
            if not last.all():
                yield solve(f[~last])
    if sum(map(len, held)):
        yield solve(pd.concat(held))


def _large_centres(classes: DataFrame) -> DataFrame:
    """(class, mask) of centres with many classes: each window by itself, as an aggregation."""
    each = classes.select("class", "key", "left", "right", "n", F.explode(F.sequence("lo", "hi")).alias("a"))
    outer = F.concat(F.expr("right(left, a)"), F.expr(f"left(right, {BLOCK - 1} - a)"))
    each = each.select("class", "a", "n", F.unhex(F.md5(F.concat(F.col("key").cast("string").cast("binary"), F.lit(b":"),
                                                         F.col("a").cast("string").cast("binary"), F.lit(b":"), outer))).alias("w"))
    each = persisted(each, "pfp-windows")
    # joined by another form of the key, so that AQE may split the windows of a frequent one
    twice = each.groupBy("w").agg(F.sum("n").alias("n")).filter("n > 1").select(F.hex("w").alias("v"))
    return (each.withColumn("v", F.hex("w")).join(twice, "v").groupBy("class")
            .agg(F.bit_or(F.expr("shiftleft(1L, a)")).alias("mask")))


def _spans(length: int):
    def run(ats: pd.Series, masks: pd.Series) -> pd.Series:
        out = []
        for at, mask in zip(ats, masks, strict=True):
            at, mask = np.asarray(at, np.int64), np.asarray(mask, np.int64).view(np.uint64)
            block = at % 256
            origin = at // 256 - block * BLOCK
            rec, a = np.nonzero(np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            starts = np.unique(origin[rec] - a)
            gap = np.flatnonzero(np.diff(starts) > length)
            out.append([*zip(starts[np.concatenate([[0], gap + 1])].tolist(),
                             (starts[np.concatenate([gap, [len(starts) - 1]])] + length).tolist(), strict=True)])
        return pd.Series([[{"start": s, "stop": e} for s, e in x] for x in out], dtype=object)
    return run


SPANS = "array<struct<start: bigint, stop: bigint>>"


def repeated_spans(docs: DataFrame, *, text_col: str = "text", length: int = LENGTH, bucket: int = BUCKET) -> DataFrame:
    """(row, spans): byte ranges, maximal and in order, that repeated strings
    of ``length`` bytes cover; rows without any are left out."""
    if length < 2 * BLOCK:
        raise ValueError(f"length must be at least {2 * BLOCK}")
    spark = docs.sparkSession
    texts = in_small_batches(docs.select(F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("t")))
    long = texts.filter(F.octet_length("t") >= length)
    parsed = persisted(long.mapInPandas(_centre_rows(length), "key bigint, row bigint, at bigint"), "pfp-parse")
    shared = parsed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    flags = persisted(joined_anew(parsed, shared, "key", "left_semi").groupBy("row").agg(F.collect_list("at").alias("flags")), "pfp-flags")
    discard(spark, parsed)
    del parsed, shared
    release(spark)
    found = persisted(long.join(flags, "row").mapInPandas(
        _record_rows(length), "key bigint, class binary, left binary, right binary, lo int, hi int, row bigint, at bigint"), "pfp-records")
    discard(spark, flags)
    release(spark)
    sides = F.first(F.struct("key", "left", "right", "lo", "hi")).alias("s")
    classes = persisted(found.groupBy("class").agg(sides, F.count(F.lit(1)).alias("n")).select("class", "s.*", "n"), "pfp-classes")
    large = persisted(classes.groupBy("key").agg(F.count(F.lit(1)).alias("classes")).filter(F.col("classes") > bucket).select("key"),
                      "pfp-large")
    small = (classes.join(large, "key", "left_anti").repartition("key").sortWithinPartitions("key")
             .mapInPandas(_order_centres, "class binary, mask bigint"))
    masks = persisted(small.unionByName(_large_centres(classes.join(large, "key", "left_semi"))
                                        .unionByName(_whole(classes.join(large, "key", "left_semi")))
                                        .groupBy("class").agg(F.bit_or("mask").alias("mask"))), "pfp-masks")
    discard(spark, classes)
    hits = found.select("class", "row", "at").join(masks, "class").groupBy("row").agg(
        F.collect_list(F.struct("at", "mask")).alias("hits"))
    spans = persisted(hits.select("row", F.pandas_udf(_spans(length), SPANS)("hits.at", "hits.mask").alias("spans")), "pfp-spans")
    discard(spark, found)
    release(spark)
    return spans


def _whole(classes: DataFrame) -> DataFrame:
    """All windows of a class with two or more records repeat."""
    return classes.filter("n > 1").selectExpr("class", "shiftleft(shiftrightunsigned(-1L, 63 - (hi - lo)), lo) AS mask")


def _with_spans(docs: DataFrame, **options) -> DataFrame:
    """(doc, spans): every row as a struct, with its spans (null: none)."""
    spans = repeated_spans(docs, **options)
    rows = docs.select(whole(docs).alias("doc"), F.monotonically_increasing_id().alias("row"))
    # spans grow with the corpus: planned at every size as the shuffle that it is at scale
    return rows.join(spans.hint("merge"), "row", "left").select("doc", "spans")


def _cut(data: bytes, spans) -> bytes:
    out, at = [], 0
    for s in spans if spans is not None else ():
        out.append(data[at:s["start"]])
        at = s["stop"]
    return b"".join([*out, data[at:]])


def digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    def run(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([hashlib.sha256(_cut(text_bytes(t), s)).hexdigest() for t, s in zip(texts, spans, strict=True)])

    some = F.coalesce("spans", F.array().cast(SPANS))
    size = F.aggregate(some, F.lit(0).cast("bigint"), lambda n, x: n + x["stop"] - x["start"])
    return _with_spans(docs, **options).select(
        "doc.doc_id", F.coalesce(F.octet_length("doc.text"), F.lit(0)).cast("bigint").alias("n_bytes"), size.alias("n_removed"),
        F.size(some).cast("bigint").alias("n_spans"), F.pandas_udf(run, "string")("doc.text", "spans").alias("kept_sha256"))


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The documents without repeated strings, in their own columns; a
    character goes if all its bytes do; n_chars follows.  Null texts stay null."""
    def run(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, cuts in zip(texts, spans, strict=True):
            if text is None or cuts is None or not len(cuts):
                out.append(text)
                continue
            data = text_bytes(text)
            whole = [{"start": _next_character(data, s["start"]), "stop": _next_character(data, s["stop"], back=True)} for s in cuts]
            out.append(_cut(data, [s for s in whole if s["start"] < s["stop"]]).decode("utf-8", "surrogatepass"))
        return pd.Series(out, dtype=object)

    kept = _with_spans(docs, **options).withColumn("kept", F.pandas_udf(run, "string")("doc.text", "spans"))
    own = {c: F.col(f"doc.`{c}`") for c in docs.columns}
    own["text"] = F.col("kept")
    if "n_chars" in own:
        own["n_chars"] = F.when(F.col("kept").isNull(), own["n_chars"]).otherwise(
            F.length("kept").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[column.alias(name) for name, column in own.items()])


def _next_character(data: bytes, at: int, back: bool = False) -> int:
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at += -1 if back else 1
    return at
