"""Phrase collocations by dynamic itemset counting (operator 13).

The texts are dealt into SHARDS tables, which are scanned in turn, round and
round.  All lengths are counted in the same scans: words from the first step
on, a longer phrase from the step on at which both phrases one word shorter
(its beginning and its end) have reached the threshold, and each until it has
seen every shard once.  The counting ends when no phrase has come up for a
whole round.  Counts are those of all occurrences.

What has reached the threshold is told to the scans as a bitmap of BITS bits
(hashes of the phrases), which has the same size for any corpus.  A bit may be
set by another phrase: then a phrase is counted that need not be.  As bits are
only ever added, whether a phrase passed a round ago follows from the bitmap of
that step, so a scan counts it there if it passes now and did not then: every
shard gives each phrase's occurrences exactly once.

In a task, texts of one language are counted some MB at a time, as numbers: a
word is 128 bits of hashes of its bytes and its language, a longer phrase is
mixed from its words'.  What leaves the task is a row of numbers for each
distinct phrase of such a stretch, summed before the shuffle.  A last scan
spells the frequent ones.  Counts are exact up to collisions of 128 bits.

Defined cases: a null or empty text has no words; a null language is ``und``,
together with rows that say so; repeated rows count each time; an empty table
gives an empty result; a text of any length is cut at its piece ends; extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import bitmap, discard, held, in_small_batches, mix64, persisted, power_tables, release, unpacked

#: Shards of a round, bits of the bitmap, and bytes of text that a task counts at a time.
SHARDS, BITS, STRETCH = 2, 1 << 26, 2 << 20
#: Bytes whose words are hashed at a time.
BLOCK = 1 << 17
#: Slices of a shard, and phrases that a task remembers having spelt.
SLICES, TOLD = 4, 4 << 20
THRESHOLD, LONGEST, SUBSUMED, SCALE, TOP = 30, 4, 80, 2_000_000, 2000
# What ends a piece, and what stands between words.
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b"\t "
_CLEAN = bytes.maketrans(PIECE_ENDS + BLANKS, b"\n" * len(PIECE_ENDS) + b" " * len(BLANKS))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_TABLES = np.random.Generator(np.random.PCG64(13)).integers(0, 2**64, (2, 256), dtype=np.uint64)


def stretches(texts: list[bytes]) -> Iterator[bytes]:
    """The texts' pieces, one a line, lower-cased, about STRETCH bytes at a time; a piece stays whole."""
    data, at = b"\n".join(texts).lower().translate(_CLEAN), 0
    while at < len(data):
        end = data.find(b"\n", at + STRETCH)
        yield data[at:end if end >= 0 else len(data)]
        at = end + 1 if end >= 0 else len(data)


def word_keys(data: bytes, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first 64 bits, last 64 bits, piece, start, end) of every word: 128 bits
    from two sums of random numbers of its bytes, of which ``seed`` is a part."""
    parts, at, line = [], 0, 0
    while at < len(data) or not parts:  # some pieces at a time, which the processor's cache holds
        end = data.find(b"\n", at + BLOCK)
        end = end + 1 if end >= 0 else len(data)
        chars = np.frombuffer(data, np.uint8, end - at, at)
        breaks = chars == 10
        edge = np.diff(np.concatenate([[False], ~breaks & (chars != 32), [False]]).astype(np.int8))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = power_tables(len(chars) + 1)
        keys = []
        for k, table in enumerate(_TABLES):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[chars] * up[:-1])])
            keys.append(mix64((sums[stop] - sums[start]) * down[start] + np.uint64(2 * seed + k)))
        lines = np.cumsum(breaks)
        parts.append((*keys, line + lines[start] if len(start) else start, start + at, stop + at))
        line += int(lines[-1]) if len(lines) else 0
        at = end
    return tuple(map(np.concatenate, zip(*parts, strict=True)))


def distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct pair, in an order that brings equal ones
    together, and how often it does.  (Pairs with equal halves ``a`` might
    alternate and come twice, which sums of their counts do not mind.)"""
    order = np.argsort(a)
    x, y = a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])) if len(x) else np.empty(0, np.int64)
    return order[first], np.diff(np.append(first, len(x)))


def runs(data: bytes, seed: int, now: np.ndarray | None, then: np.ndarray | None = None, longest: int = LONGEST):
    """(length, start of the first word, end of the last, first and last 64
    bits, whether ``then`` holds both shorter phrases) of the words and of every
    longer phrase whose beginning and end ``now`` holds; arrays by place."""
    a, b, piece, start, end = word_keys(data, seed)
    yield 1, start, end, a, b, np.zeros(len(a), bool)
    if now is None:
        return
    at, x, y = np.arange(len(a)), a, b
    new, old = held(now, x), held(then, x)
    for n in range(2, longest + 1):
        # both shorter phrases stand at neighbouring places, and the last word in the same piece
        pair = np.flatnonzero((at[1:] == at[:-1] + 1) & new[:-1] & new[1:])
        pair = pair[piece[at[pair] + n - 1] == piece[at[pair]]]
        if not len(pair):
            return
        at, last, old = at[pair], at[pair] + n - 1, old[pair] & old[pair + 1]
        x, y = mix64(x[pair] * _STEP + a[last]), mix64(y[pair] * _STEP + b[last])
        yield n, start[at], end[last], x, y, old
        new = held(now, x)
        old = old & held(then, x)


def scan(shard: DataFrame, now: Broadcast | None, then: Broadcast | None, words_too: bool, step: int, longest: int) -> DataFrame:
    """Counts of one shard: a row for each phrase of each stretch that passes
    ``now`` and did not pass ``then``.  The number of words has length 0."""
    def rows(n: int, x: np.ndarray, y: np.ndarray, times: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"n": np.int32(n), "x": x.view(np.int64), "y": y.view(np.int64), "since": np.int32(step), "count": times})

    def solver(bits: np.ndarray | None, before: np.ndarray | None):
        def count(lang: str, data: bytes) -> Iterator[pd.DataFrame]:
            seed = zlib.crc32(lang.encode())
            for n, _, _, x, y, old in runs(data, seed, bits, before, longest):
                if n == 1 and words_too and len(x):
                    yield rows(0, np.zeros(1, np.uint64), np.array([seed], np.uint64), np.array([len(x)]))
                if n > 1 or words_too:
                    x, y = (x, y) if not old.any() else (x[~old], y[~old])
                    first, times = distinct(x, y)
                    yield rows(n, x[first], y[first], times)

        return count

    return _by_stretch(shard, solver, [now, then], "n int, x bigint, y bigint, since int, count bigint")


def spell(docs: DataFrame, frequent: Broadcast, wanted: Broadcast, longest: int) -> DataFrame:
    """(x, y, lang, phrase): the texts of the phrases of ``frequent`` that are
    ``wanted``, and each language's empty one."""
    def solver(bits: np.ndarray, asked: np.ndarray):
        told = np.empty(0, np.uint64)  # what this task has spelt, so that it does so once or seldom

        def texts(lang: str, data: bytes) -> Iterator[pd.DataFrame]:
            nonlocal told
            seed, fresh = zlib.crc32(lang.encode()), [told]
            for n, start, end, x, y, _ in runs(data, seed, bits, None, longest):
                mine = np.flatnonzero(held(asked, x))
                mine = mine[distinct(x[mine], y[mine])[0]]
                if len(told):
                    place = np.minimum(np.searchsorted(told, x[mine]), len(told) - 1)
                    mine = mine[told[place] != x[mine]]
                words = [data[i:j] if n == 1 else b" ".join(data[i:j].split()) for i, j in zip(start[mine].tolist(), end[mine].tolist(), strict=True)]
                yield pd.DataFrame({"x": x[mine].view(np.int64), "y": y[mine].view(np.int64), "lang": lang, "phrase": words})
                fresh.append(x[mine])
            yield pd.DataFrame({"x": [0], "y": [seed], "lang": [lang], "phrase": [b""]})
            told = np.sort(np.concatenate(fresh[len(told) > TOLD:]), kind="stable")

        return texts

    found = _by_stretch(docs, solver, [frequent, wanted], "x bigint, y bigint, lang string, phrase binary")
    return found.withColumn("phrase", F.col("phrase").cast("string")).distinct()


def spelt(table: DataFrame, kept: DataFrame, longest: int, bits: int) -> DataFrame:
    """``kept`` with lang and phrase.  The first slice of the texts has most
    phrases; the others are looked through for what it has not."""
    context = table.sparkSession.sparkContext
    frequent = context.broadcast(bitmap(kept.filter("n > 0"), "x", bits))
    early = persisted(spell(table.filter("slice = 0"), frequent, frequent, longest), "spelt")
    rest = context.broadcast(bitmap(kept.join(early, ["x", "y"], "left_anti"), "x", bits))
    late = persisted(spell(table.filter("slice > 0"), frequent, rest, longest), "spelt")
    return kept.join(early.unionByName(late).distinct(), ["x", "y"])


def _by_stretch(docs: DataFrame, solver, maps: list[Broadcast | None], schema: str) -> DataFrame:
    """``solver(*bitmaps)``, one a task, called with the texts: (lang, data) of some MB of one language at a time."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        solve = solver(*[None if b is None else unpacked(b.value) for b in maps])
        waiting: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def work(lang: str) -> Iterator[pd.DataFrame]:
            size.pop(lang)
            for data in stretches(waiting.pop(lang)):
                yield from solve(lang, data)

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                data = text.encode()
                waiting.setdefault(lang, []).append(data)
                size[lang] = size.get(lang, 0) + len(data) + 1
                if size[lang] >= STRETCH:
                    yield from work(lang)
            if sum(size.values()) >= 4 * STRETCH:  # many languages, little of each
                for lang in list(waiting):
                    yield from work(lang)
        for lang in list(waiting):
            yield from work(lang)

    return in_small_batches(docs.select("lang", "text")).mapInPandas(run, schema)


def phrase_counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", threshold: int = THRESHOLD, longest: int = LONGEST,
                  shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """(lang, n, phrase, count): all words and phrases of up to ``longest``
    words that occur ``threshold`` times or more, and each language's number
    of words as the phrase of length 0."""
    spark = docs.sparkSession
    dealt = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        F.pmod(F.monotonically_increasing_id(), F.lit(SLICES * shards)).cast("int").alias("slice"))
    table = persisted(dealt, "slices", by="slice")
    known: DataFrame | None = None
    maps: list[bytes | None] = [None]  # of the step before each
    sent: list[Broadcast | None] = [None]
    step = 0
    while step < shards or maps[step] != maps[step - shards]:
        found = scan(table.filter(F.col("slice") % shards == step % shards), sent[step], sent[step - shards] if step >= shards else None,
                     step < shards, step, longest)
        both = found if known is None else known.unionByName(found)
        summed = both.groupBy("x", "y").agg(F.max("n").alias("n"), F.min("since").alias("since"), F.sum("count").alias("count"))
        # a phrase that has had its round and is rare stays so
        due = (F.col("n") == 0) | (F.col("count") >= threshold) | (F.col("since") + shards > step + 1)
        merged = persisted(summed.filter(due), "phrases")
        if known is not None:
            discard(spark, known)
        known = merged
        frequent = known.filter((F.col("n") > 0) & (F.col("count") >= threshold))
        maps.append(bitmap(frequent.filter(F.col("n") < longest), "x", bits))
        sent.append(sent[-1] if maps[-1] == maps[-2] else spark.sparkContext.broadcast(maps[-1]))
        release(spark)
        step += 1
    kept = known.filter((F.col("n") == 0) | (F.col("count") >= threshold))
    return persisted(spelt(table, kept, longest, bits).select("lang", "n", "phrase", "count"), "phrase-counts")


def _part(first: Column, size: Column) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def collocations(docs: DataFrame, *, top: int | None = TOP, threshold: int = THRESHOLD, subsumed: int = SUBSUMED, scale: int = SCALE,
                 longest: int = LONGEST, **options) -> DataFrame:
    """Each language's ``top`` phrases of two words or more by score, which is
    that of the weakest cut into two parts: scale * a / (l + r), floored, for a
    phrase that occurs a times and whose parts occur l and r times.  A phrase
    that stands in a longer one with ``subsumed`` percent of its occurrences
    gives way to it.  (lang, rank, phrase, a, l, r, n, score)"""
    counts = phrase_counts(docs, threshold=threshold, longest=longest, **options)
    exact = "decimal(38,0)"
    candidates = counts.filter("n > 1").select("lang", "phrase", "n", F.col("count").alias("a"), F.split("phrase", " ").alias("words"))
    spans = F.expr("flatten(transform(sequence(2, n - 1), m -> transform(sequence(1, n - m + 1), i -> array_join(slice(words, i, m), ' '))))")
    longer = (candidates.filter("n > 2").select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("above"))
              .groupBy("lang", "phrase").agg(F.max("above").alias("above")))
    own = candidates.join(longer, ["lang", "phrase"], "left").filter(
        F.col("above").isNull() | (F.col("above").cast(exact) * 100 < F.col("a").cast(exact) * subsumed))
    cut = own.select("lang", "phrase", "n", "a", "words", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("first"), _part(F.col("k") + 1, F.col("n") - F.col("k")).alias("rest"))
    parts = counts.filter((F.col("n") > 0) & (F.col("n") < longest))
    scored = (cut.join(parts.select("lang", F.col("phrase").alias("first"), F.col("count").alias("l")), ["lang", "first"])
              .join(parts.select("lang", F.col("phrase").alias("rest"), F.col("count").alias("r")), ["lang", "rest"])
              .withColumn("score", F.expr(f"CAST({scale} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + r)")))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = weakest.withColumn("rank", F.row_number().over(order))
    ranked = ranked if top is None else ranked.filter(F.col("rank") <= top)
    totals = counts.filter("n = 0").select("lang", F.col("count").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n",
                                              F.col("cut.score").cast("bigint").alias("score"))
