"""Estimates in bounded memory, as an opt-in beside the exact operators:
distinct counts that can be rolled up, and frequent items with error bounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from tessera.operators.grams import WORDS_AT_A_TIME, counted, gram_schema, handed, slices
from tessera.session import shared_path

# A sketch of 2^LG_K buckets; its relative standard error is about 1.04 / sqrt(2^LG_K).
LG_K = 14
# Counters of a task.
CAPACITY = 100_000


# ------------------------------------------------------------- distinct counts
def distinct_sketches(df: DataFrame, group: Sequence[str], value: str, *, lg_k: int = LG_K, out_col: str = "sketch") -> DataFrame:
    """One sketch a group of its distinct non-null values.  Tasks build
    sketches of their rows, so a hot group ships one sketch a task."""
    return df.groupBy(*group).agg(F.hll_sketch_agg(value, lg_k).alias(out_col))


def merge_sketches(sketches: DataFrame, group: Sequence[str], *, sketch_col: str = "sketch") -> DataFrame:
    """Sketches of coarser groups out of finer ones: values that several of
    them have seen count once, and no row is read again."""
    return sketches.groupBy(*group).agg(F.hll_union_agg(sketch_col).alias(sketch_col))


def estimate(sketch_col: str = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch_col)


def relative_bound(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """The relative error that an estimate stays below, but for one in some hundred at three deviations."""
    return deviations * 1.04 / math.sqrt(2**lg_k)


# -------------------------------------------------------------- frequent items
class Counters:
    """At most ``capacity`` counters after each ``shrink``.  A counter is too
    low by no more than ``lost``, which is at most the number of items seen
    divided by the capacity."""

    def __init__(self, capacity: int):
        self.capacity, self.lost, self.held = capacity, 0, {}

    def add(self, items) -> None:
        held = self.held
        for item in items:
            held[item] = held.get(item, 0) + 1
        if len(held) > 2 * self.capacity:
            self.shrink()

    def merge(self, counts: Iterable[tuple[object, int]]) -> None:
        """Items with the number of times that each was seen."""
        held = self.held
        for item, times in counts:
            held[item] = held.get(item, 0) + times
        if len(held) > 2 * self.capacity:
            self.shrink()

    def shrink(self) -> None:
        """Take the largest count that does not fit off all counters."""
        if len(self.held) <= self.capacity:
            return
        cut = sorted(self.held.values(), reverse=True)[self.capacity]
        self.held = {k: c - cut for k, c in self.held.items() if c > cut}
        self.lost += cut


def estimated_ngrams(df: DataFrame, n: int, *, words_col: str = "words", group: Sequence[str] = (), out_col: str = "ngram",
                     capacity: int = CAPACITY) -> DataFrame:
    """(group, ngram, at_least, at_most): bounds of the number of times that
    n-grams occur, with ``capacity`` counters a task (for all groups together)
    instead of a row an n-gram in the shuffle.

    Every n-gram more frequent than ``at_most - at_least``, the same for all,
    is in the result; that gap is at most the number of n-grams divided by the
    capacity.  The tasks' counters are written once, as their losses have to be
    known before the bounds are.  N-grams of some rows are counted together,
    and cut down to ``capacity`` as the counters are, before they come to them."""
    schema = gram_schema(df, group, StructField(out_col, StringType()), StructField("count", LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, kinds = Counters(capacity), None
        for batch in batches:
            kinds = [*[c.type for c in batch.columns[:-1]], pa.string(), pa.int64()]
            for rows in slices(batch, WORDS_AT_A_TIME):
                row, grams, times, cut = counted(rows, n, capacity)
                counters.lost += cut
                own = [c.take(pa.array(row)).to_pylist() for c in rows.columns[:-1]]
                own = [[None if v != v else v for v in c] for c in own]
                counters.merge(zip(zip(*own, grams.to_pylist(), strict=True), times.tolist(), strict=True))
        counters.shrink()
        if kinds is not None:
            columns = list(zip(*[(*k, c) for k, c in counters.held.items()], strict=True)) or [()] * len(kinds)
            lost = [*[None] * len(group), None, counters.lost]
            yield from handed([pa.array([*c, x], t) for c, x, t in zip(columns, lost, kinds, strict=True)], schema.names)

    path = shared_path(df.sparkSession, "ngram-counters")
    df.select(*group, words_col).mapInArrow(run, schema).write.parquet(path)
    held = df.sparkSession.read.schema(schema).parquet(path)
    lost = held.filter(F.col(out_col).isNull()).agg(F.sum("count")).first()[0] or 0
    return (held.filter(F.col(out_col).isNotNull()).groupBy(*group, out_col).agg(F.sum("count").alias("at_least"))
            .withColumn("at_most", F.col("at_least") + lost))
