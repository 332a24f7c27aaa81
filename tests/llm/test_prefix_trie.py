import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from llm_cases import SF

from tessera.llm import prefix_trie
from tessera.llm.queries import op11_prefix_trie

TURNS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """The contract, on whole Python tuples."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append(((t is not None, t or 0), hashlib.md5(f"{len(r)}:{r}{x}".encode()).digest(), r, x))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    made = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        made[c] = tuple(own.get(base, [])[:h] + v[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, v in made.items():
        ends[v].append(c)
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        value = (len(m) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += value
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest()) for n, m in members.items()), key=repr)


def result(df):
    assert df.columns == COLUMNS
    assert {t for c, t in df.dtypes if c != "ends_sha256"} == {"bigint"}
    return sorted((tuple(r) for r in df.collect()), key=repr)


def conversations(rng, ids, longest):
    """Few different turns, so that conversations share beginnings and some are equal."""
    rows = []
    for c in ids:
        shared = rng.random() < 0.4
        for t in range(rng.randint(1, longest)):
            text = rng.choice(["", "a", "bé", "😀 c"]) if not shared else f"turn {t}"
            rows.append((c, t * rng.choice([1, 1, 1]), rng.choice(["user", "bot"]) if not shared else "user", text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [prefix_trie.BLOCK, 4])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "CHUNK", 8)
    rng = random.Random(5)
    rows = conversations(rng, [*range(-12, 40), *range(1000, 1010)], 14)
    rows += [(77, None, "user", "x"), (77, None, None, None), (77, 3, "user", "p"), (77, 3, "bot", "q"), (77, 3, "bot", "q"),
             (None, 1, "user", "lost"), (88, 5, None, "é" * 3000), *[(91, t, "user", f"{t % 7}") for t in range(60)]]
    df = spark.createDataFrame(rows, TURNS)
    assert result(prefix_trie.trie(df)) == brute(rows)


def test_one_sequence_holds_most_conversations(spark):
    rows = [(5 * c, t, "user", f"same {t}") for c in range(300) for t in range(3)] + [(7, 0, "user", "same 0"), (11, 0, "a", "b")]
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    assert result(prefix_trie.trie(df)) == brute(rows)


def test_turnless_conversations_and_a_lone_root(spark):
    short = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:3]
    rows = [(c, 0, "user", "gone") for c in short]  # their first turns are another's, which does not exist
    got = result(prefix_trie.trie(spark.createDataFrame(rows, TURNS)))
    assert got == brute(rows) and len(got) == 1 and got[0][3] == 3


def test_empty_table_and_clashing_columns(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    rows = [(0, 0, "user", "a"), (0, 1, "bot", "b"), (3, 0, "user", "a"), (4, 1, "bot", "c")]
    df = spark.createDataFrame(rows, TURNS).selectExpr(
        "*", *[f"'{n}' AS `{n}`" for n in ("conv", "p", "key", "bytes", "d", "a", "b", "part", "length", "weight")])
    assert result(prefix_trie.trie(df)) == brute(rows)


def test_the_query_on_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(op11_prefix_trie(spark, SF)) == brute(rows)
