"""Quality classifier from compression (operator 8).

Two zstandard dictionaries are trained, one on text labelled good and one on
text labelled bad.  A document is compressed block by block with each; the
difference of the two sizes over the raw size, (bad - good) / bytes, is its
only feature, and a one-variable logistic regression fitted on labelled rows
that trained neither dictionary turns it into a probability.

Defined cases: a null or empty text scores the calibration rows' share of
good labels; with labels of one class only every text scores that class's
smoothed share, with none 0.5; null labels and null doc_ids never train;
repeated rows are scored one by one; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import in_small_batches, text_bytes

#: Bounds of the labelled sample that reaches the driver: rows of each class,
#: and bytes of one row (longer rows are not used for fitting; all are scored).
MAX_ROWS, MAX_BYTES = 1500, 16_384
DICT_BYTES, BLOCK, LEVEL = 112_640, 2048, 3
THRESHOLD = 0.7


@dataclass
class CompressionModel:
    """What scoring needs; at most two dictionaries of DICT_BYTES, so safe to ship."""

    bad: bytes
    good: bytes
    raw: bool
    weight: float
    bias: float
    prior: float

    def feature(self, data: bytes, packers: tuple) -> float:
        sizes = [sum(len(p.compress(data[i:i + BLOCK])) for i in range(0, len(data), BLOCK)) for p in packers]
        return (sizes[0] - sizes[1]) / len(data)

    def packers(self) -> tuple:
        kind = zstandard.DICT_TYPE_RAWCONTENT if self.raw else zstandard.DICT_TYPE_AUTO
        out = []
        for d in (self.bad, self.good):
            own = zstandard.ZstdCompressionDict(d, dict_type=kind)
            own.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_checksum=False,
                                                write_content_size=False, write_dict_id=False))
        return tuple(out)

    def score(self, data: bytes, packers: tuple) -> float:
        if not data or not packers:
            return self.prior
        x = max(-40.0, min(40.0, self.weight * self.feature(data, packers) + self.bias))
        return 1 / (1 + math.exp(-x))


def _blocks(texts: list[bytes]) -> list[bytes]:
    return [t[i:i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]


def _dictionaries(bad: list[bytes], good: list[bytes]) -> tuple[bytes, bytes, bool]:
    """Trained dictionaries, or plain concatenated text where a class is too
    small for the trainer."""
    try:
        return (*(zstandard.train_dictionary(DICT_BYTES, _blocks(t)).as_bytes() for t in (bad, good)), False)
    except zstandard.ZstdError:
        size = min(DICT_BYTES, *(sum(map(len, t)) for t in (bad, good)))
        return (*((b"\n".join(t))[:max(size, 8)].ljust(8) for t in (bad, good)), True)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton's method on standardised x, with a small ridge."""
    mean, scale = x.mean(), x.std() or 1.0
    a = np.stack([(x - mean) / scale, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        h = a.T @ (a * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, a.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1] - w[0] * mean / scale)


def fit(docs: DataFrame, labels: DataFrame, *, train: Column, text_col: str = "text", id_col: str = "doc_id",
        label_col: str = "quality", max_rows: int = MAX_ROWS, seed: int = 17) -> CompressionModel:
    """Learn from at most ``2 * max_rows`` rows of each class for which
    ``train`` (over the id column) holds, chosen by a seeded hash of the id:
    one half trains the dictionaries, the other calibrates."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).filter(
        f"length(t) > 0 and octet_length(t) <= {MAX_BYTES}")
    lab = (labels.select(F.col(id_col), F.col(label_col).cast("int").alias("y")).filter(train)
                 .filter("y in (0, 1)").select(F.col(id_col).alias("id"), "y").distinct())
    # ids of documents are drawn before any text moves, so only the sample's texts do
    lab = lab.join(d.select("id").distinct(), "id", "left_semi")
    order = [F.xxhash64(F.lit(seed), "id"), F.col("id")]
    drawn = [lab.filter(F.col("y") == y).orderBy(*order).limit(2 * max_rows) for y in (0, 1)]
    # of rows that share an id one text counts, so the driver gets no more rows than it drew
    pool = (d.join(F.broadcast(drawn[0].unionByName(drawn[1])), "id").groupBy("id", "y").agg(F.min("t").alias("t"))).collect()
    pool = sorted({(r["y"], r["id"], r["t"]) for r in pool})
    texts = {y: [text_bytes(t) for k, _, t in pool if k == y][:2 * max_rows] for y in (0, 1)}
    bad, good = texts[0], texts[1]
    n = len(bad) + len(good)
    prior = (len(good) + 1) / (n + 2)
    if len(bad) < 2 or len(good) < 2:
        return CompressionModel(b"", b"", True, 0.0, 0.0, prior if n else 0.5)
    halves = [(t[::2], t[1::2]) for t in (bad, good)]
    model = CompressionModel(*_dictionaries(halves[0][0], halves[1][0]), 0.0, 0.0, prior)
    packers = model.packers()
    x = np.array([model.feature(t, packers) for h in halves for t in h[1]])
    y = np.array([float(k) for k, h in enumerate(halves) for _ in h[1]])
    model.weight, model.bias = _logistic(x, y)
    return model


def score(docs: DataFrame, model: CompressionModel, *, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_bytes, score) of every row, over whole texts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packers = model.packers() if model.bad else ()
        for b in batches:
            data = [text_bytes(t) for t in b["t"]]
            yield pd.DataFrame({"id": b["id"], "n_bytes": [len(t) for t in data],
                                "score": [model.score(t, packers) for t in data]})

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return in_small_batches(slim).mapInPandas(run, f"id {kind}, n_bytes bigint, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from (a null id counts as one)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(True))


def classify(docs: DataFrame, labels: DataFrame, **fit_options) -> DataFrame:
    """doc_id, held_out, score, predicted, n_bytes for every document."""
    model = fit(docs, labels, train=~held_out(), **fit_options)
    return (score(docs, model).withColumn("held_out", held_out())
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
            .select("doc_id", "held_out", "score", "predicted", "n_bytes"))
