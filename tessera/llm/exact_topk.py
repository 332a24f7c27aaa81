"""Exact top-k inner products by a three-phase uniform threshold (operator 2).

A vector's components are cut into PARTS ranges; a score is the sum of its
partial scores over the ranges, each a local list of its own.

1. Every task gathers, for each query and range, its k highest partial scores.
   The vectors in these lists are scored in full; the k-th highest such score
   of a query is its safe cutoff: k vectors reach it, so no lower one counts.
2. The cutoffs go to every task.  Uniform threshold: a vector that reaches the
   cutoff has a partial score of at least cutoff / PARTS in some range, so
   only entries at or above that are collected.
3. An entry's missing partial scores are below the threshold, which bounds its
   sum; entries whose bound reaches the cutoff are resolved exactly, and those
   that reach it are ranked.

Queries go through in blocks of at most QUERY_BLOCK, the only thing that is
sent to all tasks, so memory does not grow with the table.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no
part; of rows with one vec_id the smallest vector counts; vectors whose length
differs from the query's are no candidates of it; fewer than k candidates give
all of them; scores are exact also beyond 2^53 (Python integers, clipped to a
long); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import persisted

K, PARTS, EVERY, QUERY_BLOCK = 10, 4, 100, 4096
ROWS = 256  # vectors scored at a time: PARTS * QUERY_BLOCK * ROWS partial scores in memory


def usable(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v array<double>): one row an id, finite vectors only."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"))
            .filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).filter(fine)
            .groupBy("id").agg(F.min("v").alias("v")))


def blocks_of(queries: DataFrame, n: int) -> Iterator[list]:
    """The rows of ``queries``, at most ``n`` at a time on the driver."""
    own = persisted(queries, "queries")
    parts = max(1, -(-own.count() // max(1, n * 3 // 4)))  # hashed parts are close to even
    for b in range(parts):
        rows = own.filter(F.pmod(F.xxhash64("id"), F.lit(parts)) == b).collect()
        for i in range(0, len(rows), n):
            yield rows[i:i + n]


class Block:
    """At most QUERY_BLOCK integer query vectors of one length."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, parts: int, k: int):
        self.ids, self.matrix, self.k = ids, matrix, k
        self.ranges = [r for r in np.array_split(np.arange(matrix.shape[1]), parts) if len(r)]
        self.most = float(np.abs(matrix).max(initial=0))
        self.cutoff = np.full(len(ids), -np.inf)

    def tiles(self, batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
        """(ids, integer vectors, partial scores[range, query, row], error bound); a query's own row scores -inf."""
        for batch in batches:
            batch = batch[batch["v"].map(len) == self.matrix.shape[1]]
            for i in range(0, len(batch), ROWS):
                part = batch.iloc[i:i + ROWS]
                ids = part["id"].to_numpy(np.int64)
                rows = np.floor(np.stack(part["v"].to_numpy()) * 1024.0)
                scores = np.stack([self.matrix[:, r] @ rows[:, r].T for r in self.ranges])
                scores[:, self.ids[:, None] == ids[None, :]] = -np.inf
                size = self.most * float(np.abs(rows).max(initial=0)) * rows.shape[1]
                yield ids, rows, scores, 0.0 if size < 2**53 else size * 1e-12


def _gather(block: Block):
    """Phase 1, in a task: the k highest partial scores of each query and range, with the full score."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for ids, _, scores, _ in block.tiles(batches):
            total = np.broadcast_to(scores.sum(axis=0), scores.shape)
            names = np.broadcast_to(ids, scores.shape)
            now = [scores, total, names]
            if held:
                now = [np.concatenate([a, b], axis=2) for a, b in zip(held, now, strict=True)]
            if now[0].shape[2] > block.k:
                top = np.argpartition(-now[0], block.k - 1, axis=2)[:, :, :block.k]
                now = [np.take_along_axis(a, top, axis=2) for a in now]
            held = now
        if held:
            part, q, at = np.nonzero(np.isfinite(held[0]))
            yield pd.DataFrame({"part": part, "q": q, "own": held[0][part, q, at], "total": held[1][part, q, at],
                                "id": held[2][part, q, at]})
    return run


def _resolve(block: Block):
    """Phases 2 and 3, in a task: (query_id, vec_id, score) that can be among the k highest."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = len(block.ranges)
        for ids, rows, scores, error in block.tiles(batches):
            cutoff = (block.cutoff - error)[:, None]
            threshold = (cutoff / n)[None]
            seen = scores >= threshold                        # phase 2: entries at or above the uniform threshold
            bound = np.where(seen, scores, threshold).sum(axis=0)
            q, r = np.nonzero(seen.any(axis=0) & (bound >= cutoff) & np.isfinite(scores[0]))
            total = scores[:, q, r].sum(axis=0)               # phase 3: what is missing of their scores
            keep = total >= cutoff[q, 0]
            q, r, total = q[keep], r[keep], total[keep]
            if error:
                total = [sum(int(a) * int(b) for a, b in zip(block.matrix[i], rows[j], strict=True)) for i, j in zip(q, r, strict=True)]
                total = [max(-2**63, min(2**63 - 1, t)) for t in total]
            yield pd.DataFrame({"query_id": block.ids[q], "vec_id": ids[r], "score": np.array(total, dtype=np.int64)})
    return run


def top_k(queries: DataFrame, vectors: DataFrame, *, k: int = K, parts: int = PARTS,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score over frames made by ``usable``."""
    spark = vectors.sparkSession
    table = persisted(vectors, "vectors")
    found = []
    for rows in blocks_of(queries, query_block):
        for width in sorted({len(r["v"]) for r in rows}):
            own = [r for r in rows if len(r["v"]) == width]
            block = Block(np.array([r["id"] for r in own]), np.floor(np.array([r["v"] for r in own]) * 1024.0), parts, k)
            lists = table.mapInPandas(_gather(block), "part int, q int, own double, total double, id bigint")
            best = Window.partitionBy("part", "q").orderBy(F.desc("own"))
            named = lists.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k).select("q", "id", "total").distinct()
            high = Window.partitionBy("q").orderBy(F.desc("total"))
            kth = named.withColumn("n", F.row_number().over(high)).filter(F.col("n") == k).select("q", "total")
            for q, total in kth.collect():  # one number a query of the block
                block.cutoff[q] = total
            found.append(table.mapInPandas(_resolve(block), "query_id bigint, vec_id bigint, score bigint"))
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (every.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def search(embeddings: DataFrame, *, every: int = EVERY, **options) -> DataFrame:
    """Queries: the usable rows whose vec_id is divisible by ``every``, against all others."""
    vectors = usable(embeddings)
    return top_k(vectors.filter(F.col("id") % every == 0), vectors, **options)
