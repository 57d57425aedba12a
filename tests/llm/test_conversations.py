"""Conversation tries against dictionaries of prefixes."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from oracle import canonical

from marketbars.llm.conversation_trie import DoubleArray, conversation_nodes
from marketbars.llm.shared import importable

SCHEMA = "conv_id long, turn long, role string, text string, depth long, p1 string, least int, h int"
COLUMNS = (
    "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
)


def by_hand(rows):
    """Nodes by dictionaries; turns that share a number must be equal."""
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    path, members = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path[c] = (*own.get(c - int(math.fmod(c, 20)), [])[:h], *turns[h:])
        for d in range(len(path[c]) + 1):
            members.setdefault(path[c][:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    total, found = {}, []
    for node in sorted(members, key=len, reverse=True):
        below = [total[k] for k in children.get(node, [])]
        words = len(node[-1][1].encode().split()) if node else 0
        saved = (len(members[node]) - 1) * words + sum(s for s, _ in below)
        total[node] = saved, sum(n for _, n in below) or 1
        ends = ",".join(str(c) for c in sorted(members[node]) if path[c] == node)
        found.append(
            (
                min(members[node]),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(members[node]),
                len(children.get(node, [])),
                total[node][1],
                saved,
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(found, key=str)


def check(spark, rows):
    importable(spark)
    found = conversation_nodes(spark.createDataFrame(rows, SCHEMA)).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in found), key=str) == by_hand(rows)
    return found


def turns(conv, texts, role="user"):
    return [(conv, i, role, t, 7, "x", 1, 2) for i, t in enumerate(texts)]


def test_trouble(spark):
    """Nulls in any column, empty and long texts, repeated rows, clashing names."""
    rows = turns(0, ["a", "b c", "", None, "long " * 30_000])
    rows += turns(3, ["a", "b c"]) + turns(20, []) + turns(23, ["x"]) + turns(41, ["a", "b c", "d"])
    rows += [(5, None, None, "first", 7, "x", 1, 2), (5, 0, "user", "a", 7, "x", 1, 2)]
    rows += 3 * [(6, 2, "user", "same", 7, "x", 1, 2)]
    rows += [(None, 1, "user", "nobody", 7, "x", 1, 2), (8, None, None, None, None, None, None, None)]
    rows += turns(60, ["q", " two\x0bwords\t", "é 漢 字"]) + turns(61, ["q", "r", "s", "t"], "assistant")
    assert len(check(spark, rows)) > 10


def test_empty(spark):
    assert conversation_nodes(spark.createDataFrame([], SCHEMA)).count() == 0
    nobody = [(None, 1, "user", "x", 1, "x", 1, 2)]
    assert conversation_nodes(spark.createDataFrame(nobody, SCHEMA)).count() == 0


def test_only_the_root(spark):
    """A conversation shorter than what it would borrow from one that is not there."""
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 0)
    found = check(spark, turns(c, ["gone"]))
    assert [(r.depth, r.n_leaves, r.n_convs) for r in found] == [(0, 1, 1)]


def test_long_and_hot(spark):
    """Conversations over several pieces, a third of all rows in one, many copies."""
    rng = random.Random(5)
    long = [f"turn {rng.randrange(4)}" for _ in range(700)]
    rows = turns(0, long) + turns(100, long[:64]) + turns(200, long[:128] + ["other"] * 70)
    rows += turns(300, long[:300] + ["end"]) + turns(320, long[:65]) + turns(340, long)
    for c in range(400, 700):
        rows += turns(c, ["hello", "how are you", "fine"] if c % 3 else ["hello", f"t{c % 7}"])
    check(spark, rows)


@pytest.mark.parametrize("seed", range(3))
def test_random(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-50, 300), 120):
        rows += turns(c, [rng.choice("ab") * rng.randrange(3) for _ in range(rng.randrange(9))])
    check(spark, rows)


def test_double_array():
    """All paths are found again, nothing else is, slots are used densely."""
    rng = np.random.default_rng(1)
    trie, known = DoubleArray(16), {}
    level = np.zeros(5000, np.int64)
    for _ in range(4):
        symbols = np.minimum(rng.geometric(0.02, len(level)), 900)
        trie.extend(level, symbols)
        after = trie.step(level, symbols)
        assert (after > 0).all()
        for key, slot in zip(zip(level.tolist(), symbols.tolist()), after.tolist(), strict=True):
            assert known.setdefault(key, slot) == slot
        level = after
    assert len(set(known.values())) == len(known)
    nodes, symbols = rng.choice(level, 2000), rng.integers(0, 1000, 2000)
    assert (trie.step(nodes, symbols) == -1).all()
    assert np.count_nonzero(trie.check >= 0) == len(known) + 1
    assert len(trie.check) < 4 * len(known)


def test_sessions(spark):
    """Another number of partitions, so that prefixes are cut elsewhere."""
    rows = []
    for c in range(200):
        rows += turns(c, ["a"] * (c % 5) + ["b", f"c{c % 11}"])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    tables = []
    try:
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            tables.append(canonical(conversation_nodes(spark.createDataFrame(rows, SCHEMA)).toPandas()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert tables[0].equals(tables[1])
