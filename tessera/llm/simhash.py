"""SimHash near-duplicates by deletion-variant signatures (operator 4).

A 64-bit fingerprint is cut into two segments of 32 bits: of two fingerprints
at 2 or fewer differing bits, one segment differs by at most one.  Every
distinct fingerprint is indexed under its one-wildcard variants (the segment
without bit j, for each j), an equality join on those 64 keys finds all
candidate pairs and a bit count verifies them.  Links between distinct
fingerprints and the copies that share one give the components.

A key that more than BUCKET distinct fingerprints share is not joined with
itself.  Its members are indexed once more, under the 65 values at one or no
differing bit from them: two fingerprints share such a value exactly if they
differ by at most two bits, so all members of a value are linked with its least
member, without pairs and without loss.

Defined cases: null and empty texts and texts of blanks have fingerprint zero
and are linked like any other; repeated rows and ids each keep their row; a
null id never names a component that has another id; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import chunks, in_small_batches, persisted, text_bytes, whole
from tessera.llm.graph import components

SHINGLE, DISTANCE, SEED, BUCKET = 3, 2, 42, 32
_BLOCK = 1 << 15


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """SimHash over runs of ``shingle`` lower-cased words, repeats included."""
    words = data.lower().split()  # of bytes: only A-Z, and the six ASCII blanks
    n = len(words)
    if not n:
        return 0
    joined, size = b" ".join(words), min(shingle, n)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[:n - size + 1].tolist()
    ends = (ends[size - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), _BLOCK):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[i:i + _BLOCK], ends[i:i + _BLOCK], strict=True)],
                     dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, text_col: str = "text", key_col: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp bigint) of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in chunks(batch, 1000):
                yield pd.DataFrame({"key": b["key"], "fp": [fingerprint(text_bytes(t), shingle) for t in b["t"]]})

    kind = docs.schema[key_col].dataType.simpleString()
    slim = docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("t"))
    return in_small_batches(slim).mapInPandas(run, f"key {kind}, fp bigint")


def _variants(fps: DataFrame) -> DataFrame:
    """(key, fp): 64 rows a fingerprint; key holds the segment, j and the 31 bits left."""
    rows = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("k"))
    rows = rows.selectExpr("fp", "k", "k % 32 AS j", "IF(k < 32, fp & 4294967295L, shiftrightunsigned(fp, 32)) AS v")
    return rows.selectExpr("(shiftleft(CAST(k AS BIGINT), 31) | shiftleft(shiftright(v, j + 1), j) "
                           "| (v & (shiftleft(1L, j) - 1))) AS key", "fp")


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(fps: DataFrame, *, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """(a, b) of distinct fingerprints(fp): every pair in a small bucket, and
    enough pairs of the large ones to connect the same components.

    Variants and balls have 64 and 65 rows a fingerprint, which Spark's sizes
    leave out (of an explode) or which pack well in a file: their joins are
    planned at every size as the sorted ones that they are at scale, as a
    broadcast of them is many times its estimate in the driver."""
    if distance != 2:
        raise ValueError("two segments with one wildcard are exact for a distance of 2")
    keys = _variants(fps)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = persisted(keys.hint("merge").join(shared, "key"), "simhash-buckets")
    few = found.filter(F.col("n") <= bucket).select("key", "fp")
    pairs = (few.select("key", F.col("fp").alias("a")).hint("merge").join(few.select("key", F.col("fp").alias("b")), "key")
             .filter((F.col("a") < F.col("b")) & (_apart(F.col("a"), F.col("b")) <= distance)).select("a", "b").distinct())
    many = found.filter(F.col("n") > bucket).select("fp").distinct()
    ball = persisted(many.select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("k"))
                     .selectExpr("fp", "IF(k = 64, fp, fp ^ shiftleft(1L, k)) AS value"), "simhash-ball")
    least = ball.groupBy("value").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = ball.hint("merge").join(least, "value").filter("fp <> a").select("a", F.col("fp").alias("b")).distinct()
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, *, text_col: str = "text", key_col: str = "doc_id", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """(key, fp, component): component is the smallest key reachable over links."""
    own = persisted(fingerprints(docs, text_col=text_col, key_col=key_col, shingle=shingle), "simhash")
    classes = persisted(own.groupBy("fp").agg(F.min("key").alias("low")), "simhash-classes")
    roots = components(links(classes.select("fp"), distance=distance))
    placed = (classes.join(roots, classes["fp"] == roots["node"], "left")
              .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    least = placed.groupBy("root").agg(F.min("low").alias("component"))
    named = persisted(placed.join(least, "root").select("fp", "component"), "simhash-named")
    return own.join(named, "fp").select("key", "fp", "component")


def near_duplicate_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    return near_duplicates(docs, **options).select(
        F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents without all but one of each component: the one of the
    smallest doc_id (of equal ids the first row)."""
    rows = persisted(docs.select(whole(docs).alias("doc"), F.monotonically_increasing_id().alias("row")), "simhash-rows")
    ids = rows.select("row", F.col("doc.doc_id").alias("id"), F.col("doc.text").alias("text"))
    groups = near_duplicates(ids, key_col="row", **options).select(F.col("key").alias("row"), "component")
    order = F.struct(F.col("id").isNull(), "id", "row")
    best = (ids.select("id", "row").join(groups, "row").groupBy("component")
            .agg(F.min(order).alias("best")).select(F.col("best.row").alias("row")))
    return rows.join(best, "row", "left_semi").select("doc.*")
