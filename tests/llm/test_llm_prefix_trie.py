"""The trie against one built in plain Python."""

import hashlib
import random
from collections import defaultdict
from zlib import crc32

import pytest

from lakemill.llm import prefix_trie as trie
from lakemill.llm.common import running

SCHEMA = "conv_id bigint, turn bigint, role string, text string, said string, chars string, pos string, block string"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, *["clash"] * 4) for r in rows], SCHEMA).repartition(partitions)


def plain_conversations(rows):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            said[conv].append(((turn is not None, turn or 0), tie, (role, text)))
    return {c: [t for *_, t in sorted(v)] for c, v in said.items()}


def plain_rebuilt(said):
    built = {}
    for c, own in said.items():
        h = crc32(str(c).encode()) % 6
        built[c] = said.get(c - c % 100 if c >= 0 else c + (-c) % 100, [])[:h] + own[h:]
    return built


def plain_trie(said):
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in said.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))

    leaves, saved = defaultdict(int), defaultdict(int)
    for path, of in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(of) - 1) * len(path[-1][1]) if path else 0
    rows = []
    for path, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(said[c]) == len(path))
        rows.append((
            min(of), len(path), min(members[path[:-1]]) if path else None, len(of), len(children[path]), leaves[path],
            saved[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=lambda r: (r[1], r[0]))


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1], r[0]))


def messy(seed=3):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 30), *range(95, 130), 205, 300, 1000, -5, -205]:
        for turn in range(rng.randrange(1, 12)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["hi", "ok", "so", None, "", "ä日"])))
    rows += [(700, t, "user", f"long {t % 3}") for t in range(83)]  # much longer than a block
    rows += [(701, t, "user", f"long {t % 3}") for t in range(71)]
    rows += [(800, None, "user", "no number"), (800, 1, "user", "later"), (800, None, "assistant", "no number")]
    rows += [(801, 1, "user", "twice")] * 5  # repeated rows
    rows += [(802, 1, r, t) for r in ("a", "b") for t in ("x", "y")]  # ties
    rows += [(1100 + i, 1, "user", "only one, and nothing in front") for i in range(1, 9)]
    rows += [(803, 0, "user", "w " * 50_000)]
    rows += [(None, 1, "user", "of no conversation"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("width", [1, 2, 4, 7])
def test_trie(spark, width):
    rows = messy()
    turns = trie.turn_rows(frame(spark, rows))
    assert found(trie.prefix_trie(turns, width)) == plain_trie(plain_conversations(rows))


def test_shared_openings(spark):
    rows = messy(4)
    turns = trie.share_openings(trie.turn_rows(frame(spark, rows)))
    built = plain_rebuilt(plain_conversations(rows))
    assert [] in built.values()  # conversations without turns are members of the root
    assert found(trie.prefix_trie(turns)) == plain_trie(built)


def test_one_conversation_and_one_node_hold_most_rows(spark):
    rows = [(1, t, "user", str(t % 5)) for t in range(3000)]
    rows += [(c, 0, "user", "same") for c in range(2, 9000, 2)]
    assert found(trie.prefix_trie(trie.turn_rows(frame(spark, rows, 6)))) == plain_trie(plain_conversations(rows))


def test_no_conversations(spark):
    none = frame(spark, [], 1)
    assert trie.prefix_trie(trie.share_openings(trie.turn_rows(none))).collect() == []


def test_running_does_not_depend_on_ranges(spark):
    from pyspark.sql import functions as F

    rows = spark.range(1000).selectExpr("id % 2 * (id % 3) AS g", "id AS o", "id % 7 AS v").repartition(5)
    total = {"s": (F.sum, F.col("v"), lambda a, b: a + b)}
    got = {(r.g, r.o): r.s for r in running(rows, "g", ["o"], total, "t").collect()}
    sums = defaultdict(int)
    for i in range(1000):
        g = i % 2 * (i % 3)
        sums[g] += i % 7
        assert got[g, i] == sums[g]
