"""The prefix trie against brute force: all shard sizes, odd input, a bounded skeleton."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import pytest

from tickloom.llm import trie

COLUMNS = "conv_id long, turn long, role string, text string, path string, shard int, depth long"


def conversations(spark, rows):
    """Turns with extra columns that clash with results and inner names."""
    return spark.createDataFrame([(*r, "clash", 3, 9) for r in rows], COLUMNS).repartition(5)


def mark(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def brute(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, mark(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in turns.items()}
    full = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + said[h:])
    members = {}
    for c, said in full.items():
        for d in range(len(said) + 1):
            members.setdefault(said[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    found = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if full[c] == node)
        above = min(members[node[:-1]]) if node else None
        found.append((min(convs), len(node), above, len(convs), children.get(node, 0), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=repr)


def made():
    dice = random.Random(3)
    rows = []
    for c in [*range(260), *range(-120, -90), 1000, 1001, 1002, 999_999]:
        for t in range(dice.choice([1, 2, 3, 4, 6, 9])):
            rows.append((c, t if dice.random() < 0.95 else None, dice.choice(["user", "assistant", None]), dice.choice(["a", "b", None, "é\U0001f600", "ccc"])))
    # One conversation in many copies, two long ones with a long common start, ties, repeated rows, no id.
    rows += [(c, t, "user", "same") for c in range(300, 380) for t in range(12)]
    rows += [(400, t, "user", f"x{t}") for t in range(300)] + [(401, t, "user", f"x{t}") for t in range(250)]
    rows += [(None, 1, "user", "none"), (5, 1, "user", "dup"), (5, 1, "user", "dup"), (6, 1, "user", "z" * 200_000)]
    return rows


def got(df):
    return sorted((tuple(r) for r in df.select(*trie.COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("shard_turns", [10**9, 200, 7, 1])
def test_nodes_equal_brute_force_at_every_shard_size(spark, monkeypatch, shard_turns):
    monkeypatch.setattr(trie, "ENDS_PIECE", 3)
    rows = made()
    assert got(trie.trie(conversations(spark, rows), shard_turns)) == brute(rows)


@pytest.mark.parametrize("bound", [{"SKELETON_NODES": 40}, {"SPLITTER_BYTES": 400}])
def test_a_bounded_skeleton_gives_the_same_nodes(spark, monkeypatch, bound):
    for name, value in bound.items():
        monkeypatch.setattr(trie, name, value)
    rows = made()
    turns = conversations(spark, rows)
    places = trie.splitters(trie.paths(turns), 5)
    assert sum(len(p) for p in {p for p, _ in places}) < 4000
    assert got(trie.trie(turns, 5)) == brute(rows)


def test_few_and_no_conversations(spark):
    for rows in ([], [(7, None, None, None)], [(None, 0, "user", "x")], [(105, 0, "user", "x")]):
        assert got(trie.trie(conversations(spark, rows))) == brute(rows)


def test_the_copies_of_one_conversation_are_dealt_to_several_shards(spark):
    turns = conversations(spark, [(c, t, "user", "same") for c in range(400) for t in range(8)])
    skeleton = trie.Skeleton.of(trie.splitters(trie.paths(turns), 300))
    rows = trie.paths(turns).collect()
    shards = {skeleton.shard(bytes(r["path"]), r["conv_id"]) for r in rows}
    assert len(shards) > 5
