"""Approximate nearest neighbours with a forest of random-projection trees (operator 5).

The trees are fitted on a bounded sample: a node splits its rows at the median
of their projection on the difference of two of them.  Every row of the table
is indexed in every tree's leaf.  A query walks all trees through one shared
priority queue, ordered by its distance to the split planes passed, until it
has named ``leaves`` leaves; the rows of those leaves are scored exactly on the
original vectors.

``leaves`` is calibrated: the fewest with which sample rows find RECALL of
their nearest sample rows.  Sample rows are sparser than the table, so their
neighbours lie further off and the table's recall comes out higher.

A query's k-th score among the sample rows of the leaves it walks is a safe
cutoff (k rows that it meets reach it), so rows below it are left out before
anything is ranked; with fewer than k such rows there is none.  A query walks
on until its leaves hold k sample rows beside itself, if there are as many.
Leaves with many rows, such as copies of one vector, are cut into chunks of
about CHUNK rows.

Defined cases: as in the exact search, and zero vectors take no part; every
length of vectors has a forest of its own, so a query finds rows of its own
length only; fewer than k candidates give all of them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import persisted
from tessera.llm.exact_topk import usable

K, EVERY = 20, 20
#: Fitting: sample rows on the driver, trees, rows of the table aimed at in a leaf, sample queries, recall aimed at.
SAMPLE, TREES, LEAF, PROBES, RECALL = 16_384, 8, 512, 200, 0.97
CHUNK = 4096
#: Scores of one pair computed in different ways differ by less than this times its lengths and its dimensions.
SLACK = 4 * np.finfo(np.float64).eps


@dataclass
class Tree:
    normals: list = field(default_factory=list)
    offsets: list = field(default_factory=list)
    children: list = field(default_factory=list)  # below zero: leaf -1 - child
    leaves: int = 0


def grow(sample: np.ndarray, capacity: int, rng: np.random.Generator) -> Tree:
    tree = Tree()

    def split(rows: np.ndarray, depth: int) -> int:
        if len(rows) > capacity and depth < 40:
            a, b = sample[rng.choice(rows, 2, replace=False)]
            if (size := np.linalg.norm(a - b)) > 0:
                p = sample[rows] @ ((a - b) / size)
                right = p > (at := float(np.median(p)))
                if right.any():
                    node = len(tree.normals)
                    tree.normals.append((a - b) / size)
                    tree.offsets.append(at)
                    tree.children.append(None)
                    tree.children[node] = (split(rows[~right], depth + 1), split(rows[right], depth + 1))
                    return node
        tree.leaves += 1
        return -tree.leaves

    root = split(np.arange(len(sample)), 0)
    if root < 0:  # one leaf: a plane with all rows on one side keeps the walk uniform
        tree.normals, tree.offsets, tree.children = [np.zeros(sample.shape[1])], [np.inf], [(root, root)]
    tree.normals, tree.offsets = np.array(tree.normals), np.array(tree.offsets)
    return tree


@dataclass
class Forest:
    """At most SAMPLE vectors, TREES * SAMPLE planes: bounded, so safe to ship."""

    trees: list[Tree]
    sample_ids: np.ndarray
    sample: np.ndarray
    leaves: int = 1

    def leaves_of(self, rows: np.ndarray) -> np.ndarray:
        """(row, tree) leaf numbers."""
        out = np.zeros((len(rows), len(self.trees)), np.int64)
        for t, tree in enumerate(self.trees):
            todo = [(0, np.arange(len(rows)))]
            while todo:
                node, at = todo.pop()
                if node < 0:
                    out[at, t] = -1 - node
                elif len(at):
                    right = rows[at] @ tree.normals[node] > tree.offsets[node]
                    todo += [(tree.children[node][0], at[~right]), (tree.children[node][1], at[right])]
        return out

    def members(self) -> list[list[np.ndarray]]:
        """The sample rows of each tree's leaves."""
        own = self.leaves_of(self.sample)
        return [np.split(np.argsort(own[:, t], kind="stable"), np.cumsum(np.bincount(own[:, t], minlength=tree.leaves))[:-1])
                for t, tree in enumerate(self.trees)]

    def walk(self, margins: list[np.ndarray], most: int, members: list[list[np.ndarray]] | None = None,
             rows: int = 0) -> list[tuple[int, int]]:
        """The first ``most`` (tree, leaf) of one query, nearest planes first, over all trees at once;
        with ``members`` more of them, until they hold ``rows`` sample rows."""
        queue, found, met = [(0.0, t, 0) for t in range(len(self.trees))], [], set()
        while queue and (len(found) < most or members is not None and len(met) < rows):
            off, t, node = heapq.heappop(queue)
            if node < 0:
                found.append((t, -1 - node))
                if members is not None and len(met) < rows:
                    met.update(members[t][-1 - node].tolist())
                continue
            m, (left, right) = float(margins[t][node]), self.trees[t].children[node]
            heapq.heappush(queue, (max(off, m), t, left))
            if right != left:
                heapq.heappush(queue, (max(off, -m), t, right))
        return found

    def margins(self, rows: np.ndarray) -> list[np.ndarray]:
        return [rows @ t.normals.T - t.offsets for t in self.trees]

    def calibrate(self, probes: int, recall: float, k: int, rng: np.random.Generator) -> None:
        n = len(self.sample)
        if n < 2:
            return
        own, at = self.leaves_of(self.sample), rng.choice(n, min(probes, n), replace=False)
        score = self.sample[at] @ self.sample.T
        score[np.arange(len(at)), at] = -np.inf
        margins, needed = self.margins(self.sample[at]), []
        for i in range(len(at)):
            place = {leaf: p for p, leaf in enumerate(self.walk([m[i] for m in margins], sum(t.leaves for t in self.trees)))}
            for near in np.argsort(-score[i], kind="stable")[:min(k, n - 1)]:
                needed.append(min(place[t, int(own[near, t])] for t in range(len(self.trees))))
        self.leaves = 1 + int(np.quantile(needed, recall, method="higher"))


def fit(vectors: DataFrame, *, rows: int, sample: int = SAMPLE, trees: int = TREES, leaf: int = LEAF,
        probes: int = PROBES, recall: float = RECALL, k: int = K, seed: int = 5) -> Forest | None:
    """A forest from the ``sample`` rows of least seeded hash; the vectors are of one length."""
    h = F.xxhash64(F.lit(seed), "id")
    # by hash first, so that tasks send little more than the sample to the driver
    some = vectors.filter(F.pmod(h, F.lit(1 << 30)) <= int(min(1.0, 1.5 * sample / max(1, rows)) * (1 << 30)))
    got = some.orderBy(h, "id").limit(sample).collect()
    if not got:
        return None
    matrix, rng = np.array([r["v"] for r in got]), np.random.default_rng(seed)
    capacity = max(8, leaf * len(got) // max(1, rows))
    forest = Forest([grow(matrix, capacity, rng) for _ in range(trees)], np.array([r["id"] for r in got]), matrix)
    forest.calibrate(probes, recall, k, rng)
    return forest


def inner(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in doubles, summed from the first component to
    the last, so that equal vectors score equally wherever they are computed."""
    total = np.zeros(len(q))
    for d in range(q.shape[1]):
        total += q[:, d] * v[:, d]
    return total


def _stack(column: pd.Series, width: int) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.empty((0, width))


def search(embeddings: DataFrame, *, k: int = K, every: int = EVERY, chunk: int = CHUNK, **fit_options) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every usable row
    whose vec_id is divisible by ``every``, among all other rows."""
    table = persisted(usable(embeddings).filter(F.exists("v", lambda x: x != 0)), "ann-vectors")
    lengths = sorted(tuple(r) for r in table.groupBy(F.size("v")).count().collect())
    found = [_search(table.filter(F.size("v") == width), width, n, k, every, chunk, fit_options) for width, n in lengths]
    if not found:
        return embeddings.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return reduce(DataFrame.unionByName, found)


def _search(table: DataFrame, width: int, n: int, k: int, every: int, chunk: int, fit_options: dict) -> DataFrame:
    """The search among the ``n`` rows of one length."""
    forest = fit(table, rows=n, k=k, **fit_options)
    shipped = table.sparkSession.sparkContext.broadcast(forest)

    def slack(q: np.ndarray, v: np.ndarray) -> np.ndarray:
        longest = np.sqrt((v * v).sum(axis=1)).max() if len(v) else 0.0
        return SLACK * width * np.sqrt((q * q).sum(axis=1)) * longest

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            leaf = shipped.value.leaves_of(_stack(b["v"], width))
            for t in range(leaf.shape[1]):
                yield pd.DataFrame({"tree": t, "leaf": leaf[:, t], "id": b["id"], "v": b["v"]})

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shipped.value
        members = own.members()
        for batch in batches:
            for i in range(0, len(batch), 256):
                b = batch.iloc[i:i + 256]
                q, ids = _stack(b["v"], width), b["id"].to_numpy()
                score = q @ own.sample.T
                score[ids[:, None] == own.sample_ids[None]] = -np.inf
                margins, less = own.margins(q), slack(q, own.sample)
                for j in range(len(b)):
                    walk = own.walk([m[j] for m in margins], own.leaves, members, k + 1)  # one may be the query itself
                    met = np.zeros(score.shape[1], bool)
                    met[np.concatenate([members[t][x] for t, x in walk])] = True
                    near = score[j, met]
                    cut = np.partition(near, -k)[-k] - less[j] if len(near) >= k else -np.inf
                    yield pd.DataFrame({"tree": [t for t, _ in walk], "leaf": [x for _, x in walk], "q": ids[j],
                                        "cut": cut, "qv": [q[j]] * len(walk)})

    rows = table.mapInPandas(index, "tree int, leaf bigint, id bigint, v array<double>")
    sizes = persisted(rows.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n"))
                      .withColumn("parts", F.ceil(F.col("n") / chunk).cast("int")).drop("n"), "ann-leaves")
    # the chunk follows the id, so that a recomputed task deals its rows the same way
    sizes = F.broadcast(sizes)  # a row a leaf: fewer than trees * sample
    dealt = (rows.join(sizes, ["tree", "leaf"])
             .withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int")).drop("parts"))
    queries = table.filter(F.col("id") % every == 0).mapInPandas(
        probe, "tree int, leaf bigint, q bigint, cut double, qv array<double>")
    asked = (queries.join(sizes, ["tree", "leaf"])
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts"))

    def rank(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        v, ids = _stack(rows["v"], width), rows["id"].to_numpy()
        for i in range(0, len(asked) if len(rows) else 0, 1024):
            b = asked.iloc[i:i + 1024]
            q, names, cut = _stack(b["qv"], width), b["q"].to_numpy(), b["cut"].to_numpy()
            score, less = q @ v.T, slack(q, v)
            score[names[:, None] == ids[None]] = -np.inf
            if len(ids) > k:  # the k best of this leaf, and what may tie with them
                cut = np.maximum(cut, np.partition(score, -k, axis=1)[:, -k] - less)
            at, near = np.nonzero((score >= (cut - less)[:, None]) & np.isfinite(score))
            out.append(pd.DataFrame({"query_id": names[at], "vec_id": ids[near], "score": inner(q[at], v[near])}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    key = ["tree", "leaf", "part"]
    found = (asked.groupBy(*key).cogroup(dealt.groupBy(*key))
             .applyInPandas(rank, "query_id bigint, vec_id bigint, score double"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
