"""The prefix trie of conversations against a walk over plain sequences."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidegate.llm import prefixes
from tidegate.llm.prefixes import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {conv: [t for _, t in sorted(turns, key=lambda x: x[0])] for conv, turns in found.items()}
    whole = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        whole[conv] = own.get(conv - conv % 20, [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(set)
    for conv, turns in whole.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[c] for c in children[node])
        ends = ",".join(str(c) for c in sorted(members[node]) if len(whole[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        numbers = (min(members[node]), len(node), parent, len(members[node]), len(children[node]), leaves[node], saved[node])
        out.append((*numbers, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(frame):
    return sorted((tuple(r) for r in prefix_trie(frame).collect()), key=str)


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(200), 60):
        for turn in range(rng.choice([1, 2, 3, 5, 9, 13, 20])):
            role = "user" if turn < 8 else rng.choice(["user", None, "a"])
            text = "hi there" if turn < 4 else rng.choice(["x y", "x\ty\x0b", "z", None, "", "   "])
            rows.append((conv, None if turn == 0 and rng.random() < 0.3 else turn, role, text))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_same_nodes_as_a_walk(spark, seed):
    rows = random_rows(seed)
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_given_table(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert result(frame) == brute(rows)


def test_long_conversations_run_over_several_spans(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "SPAN", 2)
    rows = [(c, t, "u", f"{t} {'x' if t < 30 + c else c}") for c in (20, 21, 22, 23) for t in range(40)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_copies_turnless_conversations_and_odd_rows(spark):
    # Conversations whose turns all go (no beginning to take, few turns), equal ones, rows without id, other columns.
    rows = [(c, 0, "u", "same words here") for c in range(41, 60)] + [(None, 0, "u", "lost"), (60, None, None, None)]
    rows += [(c, t, "u", "x " * 50) for c in (100, 101, 102) for t in range(9)]
    expected = brute(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in expected)
    more = [(*r, "a", "b") for r in rows]
    frame = spark.createDataFrame(more, SCHEMA + ", node string, words string")
    assert result(frame) == expected


def test_repeated_turn_numbers_have_a_stated_order(spark):
    rows = [(0, 1, "u", "b"), (0, 1, "u", "a"), (0, 1, "u", "a"), (0, 0, "u", "first")]
    one = result(spark.createDataFrame(rows, SCHEMA))
    assert one == result(spark.createDataFrame(rows[::-1], SCHEMA)) and len(one) == 5


def test_empty_table(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []
