"""Word n-grams inside a task: words are numbered, n-grams counted as numbers
some rows at a time, and only distinct ones spelt.  Tasks hand over partial
counts; Spark adds them up."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tessera.session import shared_path

# Words that are looked at together, and rows of a batch that is handed over.
WORDS_AT_A_TIME, ROWS_OUT = 1 << 20, 1 << 16
# Buckets of the upper bounds, and groups whose lower bounds the tasks are sent.
BUCKETS, GROUPS = 1 << 20, 100_000
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so invertible modulo 2^64
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Rows of about ``size`` words together; the words are the last column."""
    many = pc.fill_null(pc.list_value_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(many) - many) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for first, end in zip(cuts, cuts[1:], strict=False):
        if end > first:
            yield batch.slice(first, end - first)


class Words:
    """The words of some rows: ``code`` numbers them by place, ``owner`` is each
    one's row, ``texts`` what the numbers stand for (the last one for null)."""

    def __init__(self, lists: pa.Array):
        many = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        self.owner = np.repeat(np.arange(len(many)), many)
        found = lists.flatten().dictionary_encode()
        self.texts = pa.concat_arrays([found.dictionary, pa.nulls(1, found.dictionary.type)])
        self.code = found.indices.fill_null(len(found.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)

    def places(self, n: int) -> np.ndarray:
        """Where n-grams begin: the words after it are of the same row."""
        last = len(self.owner) - n + 1
        return np.flatnonzero(self.owner[:last] == self.owner[n - 1:]) if last > 0 else np.empty(0, np.int64)

    def parts(self, at: np.ndarray, n: int) -> list[tuple[np.ndarray, int]]:
        return [(self.code[at + j], len(self.texts)) for j in range(n)]

    def grams(self, at: np.ndarray, n: int) -> pa.Array:
        texts = [self.texts.take(pa.array(code)) for code, _ in self.parts(at, n)]
        return texts[0] if n == 1 else pc.binary_join_element_wise(*texts, " ", null_handling="skip")


def packed(parts: Sequence[tuple[np.ndarray, int]]) -> np.ndarray:
    """One number for each place, equal where the numbers (each below its width) of all parts are."""
    key, size = np.zeros(len(parts[0][0]), np.int64), 1
    for code, width in parts:
        if size * width >= 2**63:  # number those that there are
            key = np.unique(key, return_inverse=True)[1]
            size = len(key) + 1
        key, size = key * width + code, size * width
    return key


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct number, in order, and how often it comes."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
    return order[first], np.diff(np.append(first, len(key)))


def row_groups(rows: pa.RecordBatch) -> list[tuple[np.ndarray, int]]:
    """The rows' groups (all columns but the last) as numbers; rows whose values cannot be numbered stay apart."""
    out = []
    for column in rows.columns[:-1]:
        code = (np.arange(len(column)) if pa.types.is_nested(column.type) else
                column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64))
        out.append((code, len(column)))
    return out


def counted(rows: pa.RecordBatch, n: int, most: int | None = None) -> tuple[np.ndarray, pa.Array, np.ndarray, int]:
    """(row, n-gram, times, cut): the distinct n-grams of each group in some
    rows, with one of their rows.  If these are more than ``most``, the largest
    count that does not fit, ``cut``, is taken off all."""
    words = Words(rows.column(rows.num_columns - 1))
    at = words.places(n)
    first, times = distinct(packed([*[(code[words.owner[at]], width) for code, width in row_groups(rows)], *words.parts(at, n)]))
    cut = 0
    if most is not None and len(times) > most:
        cut = int(np.partition(times, len(times) - most - 1)[len(times) - most - 1])
        first, times = first[times > cut], times[times > cut] - cut
    return words.owner[at[first]], words.grams(at[first], n), times, cut


def handed(columns: Sequence[pa.Array], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    batch = pa.RecordBatch.from_arrays(list(columns), names=list(names))
    for i in range(0, batch.num_rows, ROWS_OUT):
        yield batch.slice(i, ROWS_OUT)


def gram_schema(df: DataFrame, group: Sequence[str], *more: StructField) -> StructType:
    return StructType([*[StructField(c, df.schema[c].dataType) for c in group], *more])


# ------------------------------------------------ what cannot be among the first
def _name(value) -> str:
    return repr(value + 0.0 if isinstance(value, float) else value)  # zero has one name


def group_names(rows: pa.RecordBatch) -> list[tuple[str, ...]]:
    """Each row's group, so that equal groups have equal names."""
    columns = [[_name(v) for v in c.to_pylist()] for c in rows.columns[:-1]]
    return list(zip(*columns, strict=True)) if columns else [()] * rows.num_rows


def text_hashes(texts: pa.Array) -> np.ndarray:
    """A hash of every text's bytes, from sums of powers."""
    out = []
    for i in range(0, len(texts), ROWS_OUT):
        part = pa.concat_arrays([pc.fill_null(texts.slice(i, ROWS_OUT), "")])
        _, ends, data = part.buffers()
        ends = np.frombuffer(ends, np.int32)[part.offset:part.offset + len(part) + 1]
        chars = np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]].astype(np.uint64)
        up, down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(chars), x, np.uint64)])) for x in (_BASE, _INVERSE))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((chars + np.uint64(1)) * up[:-1])])
        ends = ends - ends[0]
        out.append((sums[ends[1:]] - sums[ends[:-1]]) * down[ends[:-1]])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def buckets_of(row: np.ndarray, grams: pa.Array, names: list[tuple[str, ...]], buckets: int) -> np.ndarray:
    """The buckets of a group's n-grams, the same in every task."""
    own = np.array([zlib.crc32("\0".join(g).encode()) for g in names], np.uint64)
    keys = text_hashes(grams) + own[row] * _BASE
    keys = (keys ^ (keys >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((keys ^ (keys >> np.uint64(33))) & np.uint64(buckets - 1)).astype(np.int64)


class Bounds:
    """What a first pass learns of counts.  An n-gram comes no more often than
    all of its bucket (``above``) together, and each group's first ``k`` come at
    least as often as ``least`` says; so an n-gram whose bucket stays below that
    is not among them.  Groups that ``least`` does not have lose nothing."""

    def __init__(self, above: np.ndarray, least: dict[tuple[str, ...], int]):
        self.above, self.least = above, least

    def may_be_first(self, rows: pa.RecordBatch, row: np.ndarray, grams: pa.Array) -> np.ndarray:
        names = group_names(rows)
        least = np.array([self.least.get(g, 0) for g in names], np.int64)
        return self.above[buckets_of(row, grams, names, len(self.above))] >= least[row]


def bounds(df: DataFrame, n: int, k: int, words_col: str, group: Sequence[str], *, buckets: int = BUCKETS, groups: int = GROUPS) -> Bounds:
    """Tasks add up all their n-grams by bucket, and name the most frequent of
    every slice, whose partial counts bound the whole ones from below."""
    names = [f"g{i}" for i in range(len(group))]
    fields = (StructField("ngram", StringType()), StructField("bucket", IntegerType()), StructField("count", LongType()))
    own = df.select(*[F.col(c).alias(a) for c, a in zip(group, names, strict=True)], F.col(words_col).alias("w"))
    schema = gram_schema(own, names, *fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above, kinds = np.zeros(buckets, np.int64), None
        for batch in batches:
            kinds = [c.type for c in batch.columns[:-1]]
            for rows in slices(batch, WORDS_AT_A_TIME):
                row, grams, times, _ = counted(rows, n)
                above += np.bincount(buckets_of(row, grams, group_names(rows), buckets), weights=times, minlength=buckets).astype(np.int64)
                often = np.flatnonzero(times > 1)
                owner = packed([(np.zeros(rows.num_rows, np.int64), 1), *row_groups(rows)])[row[often]]
                order = np.lexsort([-times[often], owner])
                start = np.flatnonzero(np.concatenate([[True], np.diff(owner[order]) != 0])[:len(order)])
                rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
                first = often[order[rank < 2 * k]]
                yield from handed([*[c.take(pa.array(row[first])) for c in rows.columns[:-1]], grams.take(pa.array(first)),
                                   pa.nulls(len(first), pa.int32()), pa.array(times[first], pa.int64())], schema.names)
        used = np.flatnonzero(above)
        if kinds is not None:
            yield from handed([*[pa.nulls(len(used), t) for t in kinds], pa.nulls(len(used), pa.string()), pa.array(used, pa.int32()),
                               pa.array(above[used], pa.int64())], schema.names)

    path = shared_path(df.sparkSession, "ngram-bounds")
    own.mapInArrow(run, schema).write.parquet(path)
    held = df.sparkSession.read.schema(schema).parquet(path)
    sums = held.filter("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("count").alias("count")).toArrow()
    above = np.zeros(buckets, np.int64)
    above[sums["bucket"].to_numpy()] = sums["count"].to_numpy()
    low = held.filter("bucket IS NULL").groupBy(*names, "ngram").agg(F.sum("count").alias("count"))
    kth = low.groupBy(*names).agg(F.get(F.sort_array(F.collect_list("count"), asc=False), F.lit(k - 1)).alias("least"))
    rows = kth.filter("least > 1").orderBy(F.col("least").desc()).limit(groups).collect()
    return Bounds(above, {tuple(_name(r[a]) for a in names): r["least"] for r in rows})
