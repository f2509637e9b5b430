"""Prefix trie against a plain one, with blocks so small that nodes cross many of them."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from parcelmill.llm import convtrie

ROWS = "conv_id long, turn long, role string, text string, depth string, owner long, block string, n int"


def brute(rows, every=None, head=None):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    convs = own
    if every:
        convs = {c: own.get(c - c % every, [])[:head(c)] + v[head(c):] for c, v in own.items()}
    members = defaultdict(list)
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    found = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        words = lambda q: len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) if q else 0
        leaf = lambda q: not any(len(x) == len(q) + 1 and x[:-1] == q for x in members)
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p))))
        found.append((
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), sum(len(q) == len(p) + 1 for q in below),
            sum(map(leaf, below)), sum((len(members[q]) - 1) * words(q) for q in below), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=str)


def run(spark, rows, every=None, head=None):
    frame = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], ROWS).repartition(3)
    convs = convtrie.sequences(frame)
    if every:
        convs = convtrie.rebranched(convs, every, head)
    return sorted((tuple(r)[:8] for r in convtrie.prefix_nodes(convs).collect()), key=str)


def conversations(seed, n, starts, longest):
    draw, rows = random.Random(seed), []
    for c in range(n):
        for t in range(draw.randint(1, longest)):
            rows.append((c, t, draw.choice(["user", "assistant", None]), draw.choice(["a", "b c", "", None] * (t > 0) + ["d  e\tf"] * starts)))
    return rows


@pytest.mark.parametrize("block", [3, 9, 40, 10_000])
def test_nodes_equal_a_plain_trie(spark, monkeypatch, block):
    monkeypatch.setattr(convtrie, "BLOCK_TURNS", block)
    rows = conversations(block, 60, 2, 4)
    # A third of all are copies, some are very long copies, some turns tie.
    rows += [(100 + c, t, "user", f"copy {t}") for c in range(30) for t in range(3)]
    rows += [(200 + c, t, "user", f"long {t}") for c in range(3) for t in range(50)]
    rows += [(300, None, "b", "z"), (300, None, "a", "z"), (300, 1, "a", "z"), (300, 1, "a", "z"), (None, 0, "a", "lost")]
    assert run(spark, rows) == brute(rows)


def test_rebranched_conversations(spark, monkeypatch):
    monkeypatch.setattr(convtrie, "BLOCK_TURNS", 25)
    rows = [r for r in conversations(7, 75, 1, 4) if r[0] != 20]
    crc = lambda c: __import__("zlib").crc32(str(c).encode()) % 4
    assert run(spark, rows, 20, F.crc32(F.col("conv_id").cast("string")) % 4) == brute(rows, 20, crc)


def test_turnless_and_empty(spark):
    # 41 and 45 lose their only turns to an absent first conversation.
    rows = [(c, 0, "user", "x") for c in range(41, 60)]
    crc = lambda c: __import__("zlib").crc32(str(c).encode()) % 4
    assert run(spark, rows, 20, F.crc32(F.col("conv_id").cast("string")) % 4) == brute(rows, 20, crc)
    assert run(spark, []) == []
    only_root = run(spark, [(41, 0, "a", "b")], 20, F.lit(3))
    assert only_root == [(41, 0, None, 1, 0, 1, 0, hashlib.sha256(b"41").hexdigest())]


def test_sparse_table_searches():
    import numpy as np

    draw = random.Random(3)
    values = [draw.randint(0, 9) for _ in range(200)]
    table = convtrie.SparseTable(np.array(values))
    starts = np.arange(200)
    for depth in range(11):
        right = table.right_end(starts, np.full(200, depth))
        left = table.left_end(starts, np.full(200, depth))
        for i in range(200):
            assert right[i] == next((k for k in range(i, 200) if values[k] < depth), 200)
            assert left[i] == next((k for k in range(i, -1, -1) if values[k] < depth), -1)
