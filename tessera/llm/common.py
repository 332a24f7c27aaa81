"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import shared_path

TEXT_ROWS = 500


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def persisted(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back:
    cuts the lineage, survives lost executors, and computes ``df`` one time
    only (``checkpoint()`` would run an eager count and then a second job).
    ``by``: a column whose values are written and read apart."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df`` itself, its texts to reach Python TEXT_ROWS at a time: Spark's
    10,000 rows a batch would put hundreds of megabytes of long texts into
    each worker.  The setting is the session's and stays."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))
    return df


def joined_anew(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``left`` joined to ``right``, an aggregate by the bigint ``key``.  The
    join gets a key of its own, so that both sides are dealt out for it alone:
    AQE splits the copies of a frequent key then, which it cannot where one
    side still lies as its aggregate left it."""
    own = F.col(key).bitwiseXOR(F.lit(-1).cast("bigint")).alias("_own")
    return left.select("*", own).join(right.select(own, *[c for c in right.columns if c != key]), "_own", how).drop("_own")


def whole(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that none can clash with columns added beside it."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table made by ``persisted`` that no later plan reads."""
    jvm = spark._jvm
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_bytes(text: str | None) -> bytes:
    """UTF-8 bytes of a text (null: empty; lone surrogates cannot occur in Parquet strings)."""
    return text.encode("utf-8", "surrogatepass") if text else b""


def chunks(frame: pd.DataFrame, rows: int) -> Iterator[pd.DataFrame]:
    for i in range(0, len(frame), rows):
        yield frame.iloc[i:i + rows]


# ------------------------------------------------- sets of hashes of fixed size
_BUCKET = 32768  # bits in a row of Spark's bitmaps


def bitmap(keys: DataFrame, key: str, bits: int) -> bytes:
    """A bit for each value of the column, by its last places; the driver gets
    ``bits`` bits at most, however many there are.  Packed, as executors keep
    what they are sent on disk, too."""
    place = F.col(key).bitwiseAND(F.lit(bits - 1)) + 1
    rows = (keys.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map")).collect())
    out = bytearray(bits // 8)
    for r in rows:
        start = (r["bucket"] - 1) * (_BUCKET // 8)
        out[start:start + _BUCKET // 8] = r["map"][:len(out) - start]
    return zlib.compress(bytes(out), 1)


def unpacked(bits: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(bits), np.uint8)


def held(bits: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    """Whether the bit of each key is set (of a key in the set it is; of others, seldom)."""
    if bits is None:
        return np.zeros(len(keys), bool)
    place = keys & np.uint64(len(bits) * 8 - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


# ------------------------------------------------------- vectorised word hashes
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so invertible modulo 2^64
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base of the sums, and of its inverse."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, _INVERSE)):
            _powers[i] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base)]))
    return _powers[0][:n], _powers[1][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64-bit result."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets [start, end) of every word of ``data``."""
    solid = ~_SPACE[np.frombuffer(data, np.uint8)]
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash a word, from polynomial prefix sums over the bytes."""
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = power_tables(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64),
                           np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * up[:-1])])
    return mix64((sums[ends] - sums[starts]) * down[starts])


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every run of ``n`` words (of the whole sequence, if shorter)."""
    if not len(words):
        return np.empty(0, np.uint64)
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[j:len(words) - n + 1 + j]
    return mix64(out)


def first_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first least value (unsigned, 32 bits) in every run of
    ``width``, from running minima of blocks from both ends."""
    n = len(values) - width + 1
    blocks = np.full(-(-len(values) // width) * width, 2**64 - 1, np.uint64)
    blocks[:len(values)] = (values.astype(np.uint64) << np.uint64(32)) | np.arange(len(values), dtype=np.uint64)
    grid = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[width - 1:width - 1 + n]) & np.uint64(2**32 - 1)).astype(np.int64)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now: it does so when
    their plans are collected as garbage, which a driver with little to do puts
    off while the disks of the executors fill."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
