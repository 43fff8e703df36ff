"""The trie against one built turn by turn, with shards of any size."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from waferscope.llm import trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(convs: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    members: dict[tuple, list[int]] = {}
    for conv, turns in convs.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    children = dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, found in members.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not children[node]
            saved[node[:depth]] += (len(found) - 1) * (len(node[-1][1]) if node else 0)
    made = []
    for node, found in members.items():
        ends = ",".join(str(c) for c in sorted(found) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        made.append((min(found), len(node), parent, len(found), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return made


def found(spark, convs: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    rows = [(c, t, role, text, "x", b"") for c, turns in convs.items() for t, (role, text) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, digest string, turns binary")
    made = trie.conversations(df)
    empty = spark.createDataFrame([(c, None) for c, turns in convs.items() if not turns], "conv_id long, turns array<struct<said:binary,chars:int>>")
    nodes = trie.prefix_trie(made.unionByName(empty))
    assert nodes.columns == COLUMNS
    return [tuple(r) for r in nodes.collect()]


def some(rng: random.Random, count: int) -> dict[int, list[tuple[str, str]]]:
    """A third begin alike, a third are equal, some are empty or long."""
    convs = {}
    for c in rng.sample(range(-count, 3 * count), count):
        kind = rng.randrange(6)
        turns = [(rng.choice(["user", "assistant"]), "é😀" * rng.randrange(3)) for _ in range(rng.randrange(5))]
        convs[c] = [("user", "hello")] + turns if kind < 2 else [("user", "hello"), ("assistant", "hi")] if kind < 4 else turns
    convs[10**9] = [("user", str(n)) for n in range(300)]
    return convs


@pytest.mark.parametrize(("turns", "least", "last"), [(200_000, 16, 4_000), (1, 5, 40), (50, 4, 30)])
def test_any_shards_give_one_trie(spark, monkeypatch, turns, least, last):
    monkeypatch.setattr(trie, "TURNS_AT_ONCE", turns)
    monkeypatch.setattr(trie, "LEAST_PATHS", least)
    monkeypatch.setattr(trie, "LAST_PATHS", last)
    monkeypatch.setattr(trie, "IDS_AT_ONCE", 5)
    convs = some(random.Random(turns), 250)
    assert sorted(map(str, found(spark, convs))) == sorted(map(str, brute(convs)))


def test_small_tries(spark):
    assert found(spark, {}) == []
    for convs in ({5: []}, {5: [], 3: []}, {1: [("", "")]}, {1: [("a", "b")], 2: [("ab", "")]}, {1: [("a", "b")] * 3, 2: [("a", "b")] * 2}):
        assert sorted(map(str, found(spark, convs))) == sorted(map(str, brute(convs)))


def test_rows_become_conversations(spark):
    rows = [(1, 2, None, None), (1, None, "user", "a"), (1, 2, None, None), (None, 1, "user", "lost"), (2, 1, "user", "é😀")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    made = {r.conv_id: [(bytes(t.said), t.chars) for t in r.turns] for r in trie.conversations(df).collect()}
    digest = lambda role, text: hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
    assert made == {1: [(digest("user", "a"), 1), (digest("", ""), 0), (digest("", ""), 0)], 2: [(digest("user", "é😀"), 2)]}


@pytest.mark.parametrize("count", [0, 1, 2, 3, 1_000, 60_000])
def test_slots_are_minimal_and_verified(count):
    rng = np.random.default_rng(count)
    digests = np.unique(rng.integers(0, 2**64, size=(count, 2), dtype=np.uint64), axis=0)
    table = trie.SlotTable(digests)
    assert sorted(table.slots(digests).tolist()) == list(range(len(digests)))
    others = rng.integers(0, 2**64, size=(50, 2), dtype=np.uint64)
    for other in others if count else []:
        with pytest.raises(KeyError):
            table.slots(other[None, :])
