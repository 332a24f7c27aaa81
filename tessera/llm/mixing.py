"""Mixing sources to target weights (operator 9).

Documents are aggregated by membership pattern (the set of sources that hold
them).  A min-cost flow routes each pattern's words to its sources' quotas:
an arc gives one pass over the pattern's words at no cost and further passes
at rising cost, so nothing is repeated while fresh words are left.  Documents
are then chosen in a seeded order until each pattern's flow is used up.

The flow only sees patterns and sources, never documents.  A connected group
of sources is one flow problem; groups are solved apart, in Spark tasks.
Sources that share no document form groups of one, which need no graph search.

Selection never gathers a source: words are summed by range of a seeded hash,
twice by 1024 ranges, and only the last range, in which the words so far pass
the flow, is ordered document by document.

Defined cases: null text has size 0 and is taken 0 words; a null source is a
source of its own, last in order; an empty table gives an empty result;
repeated rows are chosen one by one and ties in the seeded order fall to the
smaller id, then to equal rows in any order; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import persisted

SHARE = 1.5          # words wanted, over all words of the corpus
PASSES = 2           # most often that a document may be used
WEIGHTS = (3, 1, 2)  # repeating, over the sources in order


def word_count(text_col: str = "text") -> Column:
    """Runs of anything but ASCII blanks (null text: 0)."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, *, share: float = SHARE, passes: int = PASSES,
            weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds r (position) and target to (source, source_size), one row a
    source.  The wanted words are shared by weight; a source's target stops
    at ``passes`` times its size and the excess goes to the others by weight.
    That is the level L with sum(min(cap, L * weight)) = wanted, found in one
    pass over the sources in order of cap / weight.  One row a source passes
    through one task here, never rows of documents."""
    w = F.array(*[F.lit(x) for x in weights])
    ranked = (sizes.withColumn("r", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
              .withColumn("w", F.get(w, F.col("r") % len(weights)).cast("bigint"))
              .withColumn("cap", F.col("source_size") * passes))
    order = Window.orderBy(F.col("cap") / F.col("w"), "r")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / F.sum("w").over(after))
    found = ranked.withColumn("level", level).withColumn("rank", F.row_number().over(order))
    fits = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("rank", "level"))
    best = F.min(fits).over(everything)["level"]
    cap = F.col("cap").cast("double")
    return found.select("r", "source", "source_size", F.least(cap, F.coalesce(best * F.col("w"), cap)).alias("target"))


# ------------------------------------------------------------------ the flow
def min_cost_flow(supply: list[int], member: list[list[int]], quota: list[int], passes: int) -> list[list[int]]:
    """Words that pattern p gives to each source in ``member[p]``.

    Successive shortest paths on: start -> pattern (``passes`` parallel arcs
    of capacity supply[p] and cost 0, 1, 3, ... per word: convex repetition
    cost) -> source -> end (capacity quota).  Bellman-Ford finds each path.
    """
    n_p, n_s = len(supply), len(quota)
    start, end = n_p + n_s, n_p + n_s + 1
    head, cap, cost, out = [], [], [], [[] for _ in range(n_p + n_s + 2)]

    def arc(u: int, v: int, c: int, price: int) -> int:
        for a, b, room, p in ((u, v, c, price), (v, u, 0, -price)):
            out[a].append(len(head))
            head.append(b)
            cap.append(room)
            cost.append(p)
        return len(head) - 2

    own: list[list[int]] = []
    for p in range(n_p):
        for k in range(passes):
            arc(start, p, supply[p], k * (k + 1) // 2)
        own.append([arc(p, n_p + s, supply[p] * passes, 0) for s in member[p]])
    for s in range(n_s):
        arc(n_p + s, end, quota[s], 0)
    while True:
        dist, via = [None] * len(out), [-1] * len(out)
        dist[start], queue = 0, [start]
        while queue:
            u = queue.pop(0)
            for e in out[u]:
                v = head[e]
                if cap[e] > 0 and (dist[v] is None or dist[u] + cost[e] < dist[v]):
                    dist[v], via[v] = dist[u] + cost[e], e
                    if v not in queue:
                        queue.append(v)
        if dist[end] is None:
            return [[cap[e ^ 1] for e in arcs] for arcs in own]
        room, v = None, end
        while v != start:
            room = cap[via[v]] if room is None else min(room, cap[via[v]])
            v = head[via[v] ^ 1]
        v = end
        while v != start:
            cap[via[v]] -= room
            cap[via[v] ^ 1] += room
            v = head[via[v] ^ 1]


def _components(patterns: DataFrame) -> DataFrame:
    """Adds ``grp`` (smallest source position of the connected group) to
    patterns(key, pattern, total).  Label propagation over patterns and
    sources; single-source patterns alone need no round."""
    p = patterns.withColumn("grp", F.array_min("pattern"))
    if not p.filter(F.size("pattern") > 1).limit(1).count():
        return p
    while True:
        low = p.select(F.explode("pattern").alias("s"), "grp").groupBy("s").agg(F.min("grp").alias("low"))
        new = (p.select("key", F.explode("pattern").alias("s")).join(low, "s")
                .groupBy("key").agg(F.min("low").alias("new")))
        p = persisted(p.join(new, "key"), "mix-groups")
        if not p.filter("new < grp").limit(1).count():
            return p.drop("new")
        p = p.drop("grp").withColumnRenamed("new", "grp")


def route(patterns: DataFrame, quotas: DataFrame, *, passes: int = PASSES) -> DataFrame:
    """(key, total, flow): the words wanted of each pattern.  ``patterns``:
    (key, pattern array<bigint> of source positions, total); ``quotas``:
    (s, quota).  One task solves one connected group of sources."""
    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key").reset_index(drop=True)
        wanted = {int(s): int(np.floor(q + 0.5)) for v, qs in zip(frame["pattern"], frame["quota"], strict=True)
                  for s, q in zip(v, qs, strict=True)}
        at = {s: i for i, s in enumerate(sorted(wanted))}
        flow = min_cost_flow([int(x) for x in frame["total"]], [[at[int(s)] for s in v] for v in frame["pattern"]],
                             [wanted[s] for s in sorted(wanted)], passes)
        return pd.DataFrame({"key": frame["key"], "total": frame["total"], "flow": [sum(f) for f in flow]})

    q = (patterns.select("key", F.posexplode("pattern").alias("i", "s")).join(quotas, "s").groupBy("key")
         .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "quota"))), lambda x: x["quota"]).alias("quota")))
    return (_components(patterns).join(q, "key").groupBy("grp")
            .applyInPandas(solve, "key string, total bigint, flow bigint"))


# ------------------------------------------------------------- the selection
def seeded_hash(id_col: str, seed: int) -> Column:
    """60 bits of an MD5 over seed and id, so that SQL can restate the order."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))),
                              1, 15), 16, 10).cast("bigint")


def _cut(docs: DataFrame, rest: DataFrame, place: Column) -> DataFrame:
    """rest(key, want) -> (key, bin, want): the value of ``place`` at which the
    words in order pass ``want``, and what is still wanted of it."""
    words = docs.withColumn("bin", place).groupBy("key", "bin").agg(F.sum("size").alias("words"))
    w = Window.partitionBy("key").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    cum = words.withColumn("before", F.coalesce(F.sum("words").over(w), F.lit(0))).join(rest, "key")
    return (cum.filter((F.col("before") <= F.col("want")) & (F.col("before") + F.col("words") > F.col("want")))
               .select("key", "bin", (F.col("want") - F.col("before")).alias("want")))


def cut_offs(docs: DataFrame, flows: DataFrame) -> DataFrame:
    """(key, whole, edge, last): every document of a pattern is used ``whole``
    times, those before ``edge`` or up to ``last`` = (h, id, row) in order
    once more.  The last document counts if at least half of it is wanted.

    The place is narrowed down by ranges of the hash, then by the id, then by
    ranges of the row's own hash, as one id may have any number of rows."""
    total, flow = F.col("total"), F.col("flow")
    rest = flows.select("key", F.when(total > 0, F.floor(flow / total)).otherwise(0).cast("int").alias("whole"),
                        F.when(total > 0, flow % total).otherwise(0).alias("want"))
    steps = [F.shiftright("h", 50), F.shiftright("h", 40), F.struct("h", "id"), F.shiftright("row", 50), F.shiftright("row", 40)]
    left, want = docs, rest.select("key", "want")
    for n, place in enumerate(steps):
        want = persisted(_cut(left, want.select("key", "want"), place), "mix-cut")
        at = want.select("key", F.col("bin").alias("here"))
        left = left.join(at, "key").filter(place.eqNullSafe(F.col("here"))).drop("here")
        if n == 2:
            same = want.select("key", F.col("bin.h").alias("h"), F.col("bin.id").alias("id"))
    w = Window.partitionBy("key").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    kept = (left.join(want.select("key", "want"), "key").withColumn("before", F.coalesce(F.sum("size").over(w), F.lit(0)))
                .filter(F.col("before") + F.col("size") / 2 <= F.col("want")))
    last = kept.groupBy("key").agg(F.max(F.struct("h", "id", "row")).alias("last"))
    # nothing of the last range fits: all that lies before it is used once more
    edge = (same.join(want.select("key", F.shiftleft("bin", 40).alias("row")), "key")
            .select("key", F.struct("h", "id", "row").alias("edge")))
    return (rest.join(edge, "key", "left").join(last, "key", "left")
                .select("key", "whole", F.col("edge"), F.col("last")))


def mix(docs: DataFrame, *, id_col: str = "doc_id", size: Column | None = None, sources: Column | None = None,
        share: float = SHARE, passes: int = PASSES, weights: tuple[int, ...] = WEIGHTS, seed: int = 11) -> DataFrame:
    """The given columns as struct ``doc``, and size, source_size, target and
    times (how often the mix uses the document).  ``sources``: array of the
    sources that hold a document (default: its ``source`` alone); a document's
    words count once in each; source_size and target are its first source's.
    Rows that share an id follow each other in the seeded order, by their
    place in the input, which must be a table read."""
    # a null source gets the empty name, others a mark before theirs, so that plain equality joins them
    named = F.transform(F.array("source") if sources is None else sources,
                        lambda x: F.coalesce(F.concat(F.lit("="), x), F.lit("")))
    full = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), F.col(id_col).alias("id"),
                       (word_count() if size is None else size).alias("size"),
                       F.sort_array(F.array_distinct(named)).alias("names"), seeded_hash(id_col, seed).alias("h"),
                       F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), 4).alias("row"))
    slim = persisted(full.select("id", "size", "names", "h", "row"), "mix")
    by_pattern = persisted(slim.groupBy("names").agg(F.sum("size").alias("total")), "mix-patterns")
    sizes = (by_pattern.select(F.explode("names").alias("source"), "total")
             .groupBy(F.when(F.col("source") != "", F.col("source")).alias("source"))
             .agg(F.sum("total").alias("source_size")))
    goal = persisted(targets(sizes, share=share, passes=passes, weights=weights)
                     .withColumn("source", F.coalesce("source", F.lit(""))), "mix-targets")
    placed = (by_pattern.select("names", "total", F.explode("names").alias("source"))
              .join(goal.select("source", "r"), "source")
              .groupBy("names").agg(F.first("total").alias("total"), F.sort_array(F.collect_list("r")).alias("pattern"))
              .withColumn("key", F.concat_ws(",", F.col("pattern").cast("array<string>"))))
    placed = persisted(placed, "mix-placed")
    flows = route(placed.select("key", F.col("pattern").cast("array<bigint>").alias("pattern"), "total"),
                  goal.select(F.col("r").cast("bigint").alias("s"), F.col("target").alias("quota")), passes=passes)
    keyed = slim.join(placed.select("names", "key"), "names").select("id", "size", "h", "row", "key")
    cuts = cut_offs(keyed, persisted(flows, "mix-flows"))
    plan = persisted(placed.join(cuts, "key").join(goal.select(F.col("r").alias("first"), "source_size", "target"),
                                                   F.col("pattern")[0] == F.col("first"))
                     .select("names", "source_size", "target", "whole", "edge", "last"), "mix-plan")
    place = F.struct("h", "id", "row")
    again = F.coalesce(place < F.col("edge"), F.lit(False)) | F.coalesce(place <= F.col("last"), F.lit(False))
    return (full.join(plan, "names").withColumn("times", F.col("whole") + again.cast("int"))
                .select("doc", "id", "size", "source_size", "target", "times"))


def taken(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, times of every document."""
    return mix(docs, **options).select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                                       (F.col("size") * F.col("times")).alias("taken"), "times")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix in their own columns, one row for every use."""
    m = mix(docs, **options).filter("times > 0")
    return m.select("doc", F.explode(F.sequence(F.lit(1), "times"))).select("doc.*")
