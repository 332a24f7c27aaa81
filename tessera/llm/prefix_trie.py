"""Prefix trie of rebuilt conversations, by whole-sequence collapse (operator 11).

1. Every conversation is rebuilt: its first turns come from the conversation
   that its id points to, the others are its own.  From here on a turn is a
   128-bit digest and a byte count; texts move no further.
2. A node (a sequence of first turns) is named by two running exclusive-ors of
   64-bit hashes of (turn, place), 128 bits in all.
3. Identical rebuilt conversations collapse into one weighted sequence, with
   the list of conversations that end there.  Only one path a sequence is kept,
   that of its smallest conversation.
4. A sequence that is a proper prefix of another is dropped by an anti-join
   with the inner nodes: what stays are the leaves.
5. The prefixes of the weighted sequences are aggregated by node.  For sums
   over subtrees every node belongs to the sequence of its smallest member, so
   the nodes of a sequence are the lower end of its path, and the sum below a
   node is the sum, over the sequences through it, of what they own below it.

Aggregates by node are partial before their shuffle, so a first turn that all
conversations share costs a row a task.  The only join on a key that can be hot
(a node's parent) is one that AQE splits.  Conversations are numbered and
accumulated in blocks of BLOCK turns, so that a very long one is spread.  A
node's list of ends is put together in chunks of at most CHUNK ids and hashed
by streaming the chunks in order; SHA-256 has no way to be split, but no task
holds more than a batch of chunks.

Defined cases: rows without a conversation id take no part; a null role or text
is empty; rows of one conversation with the same turn are ordered by the digest
of role and text, repeated rows count as turns of their own; more than BLOCK
rows of one conversation with turns close to each other (or none) are sorted by
one task, with spilling; an empty table has no members, so not even a root;
ids below zero point towards zero (-3 to 0); extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import discard, in_small_batches, persisted

#: Ids that share the first turns of one conversation, and the number of cuts that an id's checksum chooses among.
EVERY, CUTS = 5, 9
#: Turns a block of a conversation, and ids a chunk of a list of ends.
BLOCK, CHUNK = 1024, 4096
_NODE = ("a", "b", "d")


def _shares(first: Column, second: Column) -> Column:
    return F.floor(first / second).cast("bigint")


def ordered_turns(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv, p, key, bytes): every conversation's turns numbered from 1."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    turn = F.col(turn_col).cast("bigint")
    slim = (conversations.filter(F.col(conv_col).isNotNull())
            .select(F.col(conv_col).cast("bigint").alias("conv"), turn.alias("turn"),
                    F.coalesce(turn.bitwiseAND(F.lit(-BLOCK).cast("bigint")), F.lit(-2**63)).alias("part"),
                    F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
                    F.octet_length(text).cast("bigint").alias("bytes")))
    placed = slim.withColumn("p", F.row_number().over(
        Window.partitionBy("conv", "part").orderBy(F.col("turn").asc_nulls_first(), "key")))
    # a conversation of one part needs no more; of the others each part begins behind those before it
    before = (placed.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
              .select("conv", "part", F.sum("n").over(Window.partitionBy("conv").orderBy("part")
                                                      .rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
              .filter("before > 0"))
    return (placed.join(before, ["conv", "part"], "left")
            .select("conv", (F.col("p") + F.coalesce("before", F.lit(0))).cast("bigint").alias("p"), "key", "bytes"))


def rebuilt(turns: DataFrame, *, every: int = EVERY, cuts: int = CUTS) -> tuple[DataFrame, DataFrame]:
    """(conv, length) of every conversation, and (conv, length, d, key, bytes)
    of its turns: the first ``crc32(conv) % cuts`` of conversation ``conv -
    conv % every``, then its own behind as many of its own."""
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    own = sizes.select("conv", "n", (F.crc32(F.col("conv").cast("string")) % cuts).alias("cut"),
                       (F.col("conv") - F.col("conv") % every).alias("base"))
    heads = sizes.filter(F.col("conv") % every == 0).select(F.col("conv").alias("base"), F.col("n").alias("held"))
    given = F.least("cut", F.coalesce("held", F.lit(0)))
    members = own.join(heads, "base", "left").select(
        "conv", "base", "cut", given.alias("given"), (given + F.greatest(F.col("n") - F.col("cut"), F.lit(0))).alias("length"))
    first = turns.filter((F.col("conv") % every == 0) & (F.col("p") < cuts)).withColumnRenamed("conv", "base")
    lent = members.join(first, "base").filter("p <= cut").select("conv", "length", F.col("p").alias("d"), "key", "bytes")
    kept = turns.join(members, "conv").filter("p > cut").select(
        "conv", "length", (F.col("given") + F.col("p") - F.col("cut")).alias("d"), "key", "bytes")
    return members.select("conv", "length"), lent.unionByName(kept)


def accumulated(rows: DataFrame, aggregate: Callable[[Column], Column], merge: Callable[[Column, Column], Column],
                columns: list[str], *, backwards: bool = False) -> DataFrame:
    """``columns`` accumulated along each conversation, up to and with all rows
    of the same depth ``d`` (from the far end if ``backwards``).  Whole blocks
    of conversations longer than a block are accumulated first."""
    def along(c: str) -> Column:
        return F.col(c).desc() if backwards else F.col(c).asc()

    rows = rows.withColumn("block", _shares(F.col("d"), F.lit(BLOCK)))
    inside = Window.partitionBy("conv", "block").orderBy(along("d")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = (rows.filter(F.col("length") >= BLOCK).groupBy("conv", "block")
              .agg(*[aggregate(F.col(c)).alias(c) for c in columns]))
    before = Window.partitionBy("conv").orderBy(along("block")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("conv", "block", *[F.coalesce(aggregate(F.col(c)).over(before), F.lit(0)).alias(f"{c}_before")
                                               for c in columns])
    near = rows.select(*[c for c in rows.columns if c not in columns], *[aggregate(F.col(c)).over(inside).alias(c) for c in columns])
    return near.join(offsets, ["conv", "block"], "left").select(
        *[c for c in near.columns if c not in columns and c != "block"],
        *[merge(F.col(c), F.coalesce(f"{c}_before", F.lit(0))).alias(c) for c in columns])


def paths(conversations: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(conv, length) and, of every place of every rebuilt conversation, (conv,
    length, d, bytes, a, b, pa, pb): the node's name and its parent's."""
    turns = persisted(ordered_turns(conversations, **options), "ordered-turns")
    members, sequence = rebuilt(turns)
    members = persisted(members, "members")
    own = [F.xxhash64("key", "d"), F.xxhash64("d", F.lit("second"), "key")]
    hashed = persisted(sequence.select("conv", "length", "d", "bytes", own[0].alias("a"), own[1].alias("b")), "rebuilt")
    named = accumulated(hashed.select("*", F.col("a").alias("last_a"), F.col("b").alias("last_b")), F.bit_xor,
                        lambda x, y: x.bitwiseXOR(y), ["a", "b"])
    discard(turns.sparkSession, turns)
    places = persisted(named.select("conv", "length", "d", "bytes", "a", "b", F.col("a").bitwiseXOR(F.col("last_a")).alias("pa"),
                                           F.col("b").bitwiseXOR(F.col("last_b")).alias("pb")), "paths")
    discard(turns.sparkSession, hashed)
    return members, places


def ends_digest(ends: DataFrame) -> DataFrame:
    """(a, b, d, ends_sha256) of (conv, a, b, d): the hash of each node's ids in ascending order, comma-joined."""
    listed = F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string")))
    chunked = (ends.groupBy(*_NODE, _shares(F.col("conv"), F.lit(CHUNK)).alias("chunk")).agg(listed.alias("ids"))
               .repartition(*_NODE).sortWithinPartitions(*_NODE, "chunk"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for batch in batches:
            done = []
            for *name, ids in zip(*[batch[c] for c in (*_NODE, "ids")], strict=True):
                if name == node:
                    state.update(b"," + ids.encode())
                    continue
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = name, hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=[*_NODE, "ends_sha256"])
        if node:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=[*_NODE, "ends_sha256"])

    return in_small_batches(chunked.select(*_NODE, "ids")).mapInPandas(hashed, "a bigint, b bigint, d bigint, ends_sha256 string")


def trie(conversations: DataFrame, **options) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    members, places = paths(conversations, **options)
    root = [F.lit(0).cast("bigint").alias(c) for c in ("a", "b", "d")]
    ends = places.filter("d = length").select("conv", *_NODE).unionByName(members.filter("length = 0").select("conv", *root))
    # whole sequences, each with its weight and smallest conversation
    sequences = persisted(ends.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("weight"), F.min("conv").alias("conv")), "sequences")
    steps = places.join(sequences.select("conv", "weight"), "conv")
    inner = (steps.filter("d < length").select(*_NODE)
             .unionByName(steps.filter("d = 1").select(*root)).distinct())  # the root is a prefix of every sequence with turns
    leaves = sequences.join(inner, list(_NODE), "left_anti").select("conv", F.lit(1).alias("leaf"))
    # every prefix of every sequence, the root's too; a row of all it needs
    weighted = sequences.select("conv", "weight").join(leaves, "conv", "left").select("conv", "weight", F.coalesce("leaf", F.lit(0)).alias("leaf"))
    none = F.lit(0).cast("bigint")
    along = persisted(
        places.join(weighted, "conv").select("conv", "length", *_NODE, "pa", "pb", "bytes", "weight", "leaf").unionByName(
            sequences.select("conv", F.col("d").alias("length")).join(weighted, "conv").select(
                "conv", "length", *root, none.alias("pa"), none.alias("pb"), none.alias("bytes"), "weight", "leaf")), "prefixes")
    nodes = persisted(along.groupBy(*_NODE).agg(
        F.sum("weight").alias("n_convs"), F.min(F.struct("conv", "length")).alias("owner"), F.sum("leaf").alias("n_leaves"),
        F.max("bytes").alias("bytes"), F.max("pa").alias("pa"), F.max("pb").alias("pb")).select("*", "owner.*").drop("owner"), "nodes")
    # what a sequence owns goes to every node of its path at or above it
    owned = nodes.select(
        "conv", "length", "d", F.lit(None).cast("bigint").alias("a"), F.lit(None).cast("bigint").alias("b"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    both = persisted(along.select("conv", "length", "d", "a", "b", none.alias("saved")).unionByName(owned), "owned")
    below = accumulated(both, F.sum, lambda x, y: x + y, ["saved"], backwards=True).filter("a IS NOT NULL")
    parts = (below.groupBy(*_NODE).agg(F.sum("saved").alias("saved")).select(*_NODE, "saved", none.alias("child"), F.lit(None).cast("string").alias("sha"))
             .unionByName(nodes.filter("d > 0").groupBy("pa", "pb", "d").agg(F.count(F.lit(1)).alias("child"))
                          .select(F.col("pa").alias("a"), F.col("pb").alias("b"), (F.col("d") - 1).alias("d"), none.alias("saved"),
                                  "child", F.lit(None).cast("string").alias("sha")))
             .unionByName(ends_digest(ends).select(*_NODE, none.alias("saved"), none.alias("child"), F.col("ends_sha256").alias("sha"))))
    sums = parts.groupBy(*_NODE).agg(F.sum("saved").alias("saved_tokens"), F.sum("child").alias("n_children"), F.max("sha").alias("sha"))
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), (F.col("d") + 1).alias("d"), F.col("conv").alias("parent_conv_id"))
    return (nodes.join(sums, list(_NODE)).join(parents, ["pa", "pb", "d"], "left").select(
        F.col("conv").alias("conv_id"), F.col("d").alias("depth"), F.when(F.col("d") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))
