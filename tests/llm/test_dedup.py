import hashlib
import random
import re

import numpy as np
import pytest

from parcelmill.llm import exactdup, neardup
from parcelmill.llm.components import components
from tests.llm.fixtures import DOCS, awkward, frame, words


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("budget", [1, exactdup.BUDGET])
def test_exact_groups_equal_brute_force(spark, budget):
    texts = awkward() + [(100 + i, "copy " * (i % 3 + 1)) for i in range(90)]
    got = exactdup.exact_groups(frame(spark, texts), budget=budget).collect()
    assert len(got) == len(texts)
    groups: dict = {}
    for i, t in texts:
        groups.setdefault(_lower(t), []).append(i)
    for r in got:
        key = next(k for k in groups if hashlib.sha256(k.encode()).hexdigest() == r.text_sha256)
        ids = [i for i in groups[key] if i is not None]
        assert r.group_size == len(groups[key]) and r.keep_id == (max(ids) if ids else None)
    kept = [r for r in got if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(hashlib.sha256(k.encode()).hexdigest() for k in groups)


def test_smallest_id_can_stay_and_rows_are_kept_whole(spark):
    texts = [(1, "A b"), (2, "a B"), (2, "a B"), (3, None), (4, "")]
    got = exactdup.exact_groups(frame(spark, texts), keep="smallest").where("kept").collect()
    assert sorted(r.doc_id for r in got) == [1, 3]
    left = exactdup.drop_copies(frame(spark, texts))
    assert left.columns == [f.name for f in DOCS.fields]
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(2, "a B"), (4, "")]
    assert exactdup.exact_groups(frame(spark, [])).count() == 0


def test_columns_of_any_name_stay_as_they_are(spark):
    rows = [(1, "a", 77, 1, "x"), (2, "A", 88, 2, "y"), (3, "b", 99, 3, "z"), (3, "b", 98, 4, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _ID long, _key long, _nth string")
    left = sorted(map(tuple, exactdup.drop_copies(docs).collect()))
    assert left[0] == rows[1] and left[1] in rows[2:] and len(left) == 2
    again = sorted(map(tuple, exactdup.drop_copies(docs.repartition(3, "_key")).collect()))
    assert again == left  # which of two rows with one id and text stays does not depend on the layout


def test_trie_keeps_all_keys_and_spills_subtrees():
    draw = random.Random(1)
    trie, keys = exactdup.Trie(), {}
    for _ in range(3000):
        key = bytes(draw.choice(b"abc") for _ in range(draw.randint(0, 12)))
        node = trie.insert(key)
        node[2] = keys[key] = keys.get(key, 0) + 1
    assert dict(trie.terminals()) == keys
    gone = dict(trie.split_off(trie.held // 3))
    left = dict(trie.terminals())
    assert gone and not gone.keys() & left.keys() and {**gone, **left} == keys


def test_tries_count_their_nodes_and_cut_long_paths():
    draw = random.Random(4)
    short = lambda i: b"%d" % draw.randint(0, 10**9)
    shared = lambda i: b"one beginning of all " + short(i)
    nested = lambda i: b"a" * (i % 700)
    for make in (short, shared, nested):
        trie, keys, gone = exactdup.Trie(), set(), []
        for i in range(5000):
            key = make(i)
            keys.add(key)
            node = trie.insert(key)
            node[2] = 1
            if trie.full(400 * exactdup.NODE):
                before, some = trie.held, dict(trie.split_off(trie.held // 2))
                gone += some
                assert trie.held <= before // 2 + 65 * 2 * exactdup.NODE and trie.depth == 0
        assert set(gone) | {k for k, _ in trie.terminals()} == keys
        assert exactdup._size(trie.root) == trie.held + exactdup.NODE


def test_texts_that_begin_each_other_are_grouped(spark, monkeypatch):
    monkeypatch.setattr(exactdup, "DEPTH", 20)
    texts = [(i, "Ab" * (i % 90)) for i in range(400)]
    got = exactdup.exact_groups(frame(spark, texts)).collect()
    assert len(got) == 400 and sum(r.kept for r in got) == 90
    assert all(r.keep_id == max(range(r.doc_id % 90, 400, 90)) for r in got)


def _set(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", _lower(text)) if x]
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def _brute(texts):
    sets = [_set(t) for _, t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    named: dict = {}
    for i, (doc, _) in enumerate(texts):
        if doc is not None:
            named[root(i)] = min(named.get(root(i), doc), doc)
    return sorted((str(d), len(sets[i]), str(named.get(root(i)))) for i, (d, _) in enumerate(texts))


def _family(seed, n, edits):
    """A family whose members drift from each other, so links form chains."""
    draw, now, found = random.Random(seed), words(seed, 120), []
    for _ in range(n):
        now = now.copy()
        for _ in range(draw.randint(0, edits)):
            now[draw.randrange(len(now))] = f"w{draw.randrange(10**6)}"
        found.append(" ".join(now))
    return found


@pytest.mark.parametrize("block", [neardup.BLOCK, 5])
def test_near_groups_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "CLOSEST", 1)
    texts = awkward()
    texts += [(200 + i, t) for i, t in enumerate(_family(11, 40, 2) + _family(12, 40, 4) + _family(13, 25, 6))]
    shared = " ".join(words(14, 90))  # a passage that many documents share
    texts += [(400 + i, shared + " " + " ".join(words(500 + i, 60))) for i in range(25)]
    got = neardup.near_groups(frame(spark, texts)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == _brute(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("hot", [None, 7])
def test_texts_of_a_hot_id_are_read_once(spark, hot):
    from pyspark.sql import functions as F

    texts = [(hot, t) for t in _family(21, 60, 3)] + [(100 + i, t) for i, t in enumerate(_family(22, 30, 3))]
    texts += texts[:20]
    got = neardup.near_groups(frame(spark, texts)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == _brute(texts)
    docs = frame(spark, texts).select("doc_id", "text").withColumn("hash", F.xxhash64("text"))
    rows = neardup._profiles(docs)
    nodes = rows.where("bands IS NOT NULL").dropDuplicates(["digest"]).withColumnRenamed("seq", "node")
    assert neardup._texts_of(docs, nodes).count() <= len(texts)


def test_near_groups_of_empty_tables_and_texts(spark):
    assert neardup.near_groups(frame(spark, [])).count() == 0
    got = neardup.near_groups(frame(spark, [(1, None), (2, "")])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert neardup.drop_near(frame(spark, awkward())).columns == [f.name for f in DOCS.fields]


def test_odd_sketch_estimates_high_similarity():
    draw = np.random.default_rng(3)
    for share in (0.95, 0.85, 0.75):
        n = 2000
        both = draw.integers(0, 2**63, n, dtype=np.uint64)
        rest = int(n * (1 - share) / (1 + share))
        a = np.concatenate([both[rest:], draw.integers(0, 2**63, rest, dtype=np.uint64)])
        sampled = np.array([neardup.samples(np.unique(x)) for x in (a, both)])
        ones = int(np.bitwise_count(np.bitwise_xor(*neardup.odd_sketches(sampled)).view(np.uint64)).sum())
        differing = -neardup.BITS / 2 * np.log(1 - 2 * ones / neardup.BITS)
        assert abs(1 - differing / (2 * neardup.SAMPLES) - share) < 0.12
        assert ones <= neardup.most_ones()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
