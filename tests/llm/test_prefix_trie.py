"""Prefix trie and list ranking against plain versions."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tillwright.llm import prefix_trie as module
from tillwright.llm.list_rank import list_sums
from tillwright.llm.prefix_trie import prefix_trie

ROWS = "conv_id long, turn long, role string, text string, node long, place int, n int, mark1 string"


def frame(spark, rows):
    """Rows with further columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], ROWS)


def plain(rows):
    """The contract, with sequences as tuples."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        opener = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(opener, [])[:h] + turns[h:])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in below)
        ends = ",".join(str(c) for c in sorted(members[node]) if len(rebuilt[c]) == len(node))
        out.append(
            (
                min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                len(below), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def found(spark, rows, **more):
    return sorted(map(tuple, prefix_trie(frame(spark, rows), **more).collect()), key=repr)


def conversations(seed, n, alike=0):
    rng = random.Random(seed)
    rows = []
    for c in [rng.randrange(-50, 4000) for _ in range(n)]:
        rows += [(c, t, rng.choice(["user", "bot"]), rng.choice(["a b", "c", "d  e\tf"])) for t in range(rng.randrange(1, 6))]
    for c in range(5000, 5000 + alike):
        rows += [(c, t, "user", "the same words") for t in range(6)]
    return rows


def test_against_plain(spark):
    rows = conversations(1, 120, alike=70)
    assert found(spark, rows) == plain(rows)


def test_rounds_blocks_and_chunks(spark, monkeypatch):
    """Small limits, so that lists are contracted, marks cross blocks and ends cross chunks."""
    monkeypatch.setattr(module, "STEP", 3)
    monkeypatch.setattr(module, "CHUNK", 5)
    rows = conversations(2, 25, alike=33) + [(777, t, "user", f"turn {t % 7}") for t in range(40)]
    assert found(spark, rows, finish=20) == plain(rows)


def test_edges(spark):
    rows = [
        (None, 0, "user", "no conversation"),
        (0, None, "user", "first"),
        (0, 1, None, None),
        (0, 1, "user", "tie"),
        (0, 1, "user", "tie"),
        (1, 0, "user", ""),
        (2, 0, "user", "alone"),
        (45, 0, "user", "opener is absent"),
        (-3, 0, "user", "below zero"),
        (19, 0, "user", "long " * 5000),
        (20, 3, "a", "bc"),
        (21, 3, "ab", "c"),
    ]
    for c in range(60, 75):  # some of these lose all their turns
        rows.append((c, 0, "user", "x"))
    assert found(spark, rows) == plain(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in found(spark, rows))


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []


@pytest.mark.parametrize("size,finish", [(0, 4), (1, 4), (3, 4), (300, 10)])
def test_list_sums(spark, size, finish):
    order = random.Random(size).sample(range(10 * size + 1), size)
    rows = [(i, order[k + 1] if k + 1 < size else None, i % 7, 1) for k, i in enumerate(order)]
    sums, _ = list_sums(spark.createDataFrame(rows, "id long, next long, a long, b long"), ["a", "b"], finish)
    want, total = {}, 0
    for k, i in enumerate(order):
        want[i] = (total, k)
        total += i % 7
    assert {r.id: (r.a, r.b) for r in sums.collect()} == want


def test_no_single_list(spark):
    for rows in ([(1, 2, 1), (2, 1, 1)], [(1, None, 1), (2, None, 1)]):
        with pytest.raises(ValueError):
            list_sums(spark.createDataFrame(rows, "id long, next long, a long"), ["a"])


def test_given_table(spark, data):
    rows = spark.read.parquet(f"{data}/conversations.parquet")
    whole = [tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, prefix_trie(rows).collect()), key=repr)
    assert got == plain(whole)
    assert sum(r[3] for r in got if r[1] == 0) == rows.select(F.countDistinct("conv_id")).first()[0]
