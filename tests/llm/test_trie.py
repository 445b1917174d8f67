import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tallyloom.llm import prefix_trie
from tallyloom.llm.prefix_trie import DoubleArray, conversation_trie, dense_ids

SCHEMA = "conv_id long, turn long, role string, text string, path string, n long, node int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(spark, rows):
    df = spark.createDataFrame([(*r, "k", 3, 4) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in conversation_trie(df).select(*COLUMNS).collect()), key=repr)


def brute(rows):
    def late(i):
        return (i is None, i or 0)

    own = defaultdict(list)
    for conv, turn, role, text in rows:
        own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    for told in own.values():
        told.sort(key=lambda t: t[:2])
    rebuilt = {}
    for conv, told in own.items():
        h = 0 if conv is None else zlib.crc32(str(conv).encode()) % 6
        # Remainders keep the sign of the id.
        base = [] if conv is None else own.get(conv - (abs(conv) % 100) * (1 if conv >= 0 else -1), [])
        rebuilt[conv] = [t[1:] for t in base[:h] + told[h:]]
    members = defaultdict(list)
    for conv, told in rebuilt.items():
        for d in range(len(told) + 1):
            members[tuple(told[:d])].append(conv)
    out = []
    for prefix, convs in members.items():
        under = [p for p in members if p[: len(prefix)] == prefix]
        ends = sorted((c for c in convs if len(rebuilt[c]) == len(prefix)), key=late)
        out.append((
            min(convs, key=late), len(prefix), min(members[prefix[:-1]], key=late) if prefix else None, len(convs),
            sum(len(p) == len(prefix) + 1 for p in under),
            sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in under) for p in under),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in under if p),
            hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def made(seed, convs, words, turns):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 600), convs):
        for t in range(rng.randint(1, turns)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(words)))
    return rows


@pytest.mark.parametrize("limit", [4, 60, 100_000])
def test_nodes_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", limit)
    monkeypatch.setattr(prefix_trie, "ID_BLOCK", 8)
    rows = made(limit, 90, ["hi", "é😀", "", "long text"], 9)
    assert found(spark, rows) == brute(rows)


def test_a_long_shared_head_is_cut_deep(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 30)
    head = [f"turn {i}" for i in range(11)]
    rows = [(c * 100, t, "user", text) for c in range(12) for t, text in enumerate([*head, f"own {c % 5}", "end"])]
    rows += [(1_300, t, "user", text) for t, text in enumerate(head[:6])] + [(1_400, 0, "user", "other")]
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, None, "b"), (None, 0, "user", "a"), (None, 1, "x", "y"),
        (3, 0, "use", "ra"), (4, 0, "user", "x" * 100_000), (100, 5, "user", "base"), (101, 0, "user", "a"), (205, 0, "user", "gone"),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, [(None, 0, "user", "a")]) == brute([(None, 0, "user", "a")])
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_many_copies_of_one_conversation(spark):
    rows = [(c, t, "user", "same") for c in range(0, 90_000, 100) for t in range(3)]
    got = found(spark, rows)
    ends = hashlib.sha256(",".join(str(c) for c in range(0, 90_000, 100)).encode()).hexdigest()
    assert got[3] == (0, 3, 0, 900, 0, 1, 899 * 4, ends) and len(got) == 4


def test_double_array_finds_exactly_its_prefixes():
    rng = np.random.default_rng(4)
    rows = [rng.integers(0, 30, rng.integers(0, 6)) for _ in range(400)]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    depths = np.concatenate([np.arange(len(r)) for r in rows])
    ids = dense_ids(np.concatenate(rows)[:, None].astype(np.uint64), depths)
    trie = DoubleArray(ids, starts)
    prefixes = {tuple(ids[a:b][:d].tolist()) for a, b in zip(starts, starts[1:]) for d in range(b - a + 1)}
    assert (trie.check >= 0).sum() == len(prefixes)
    assert len(trie.check) < 4 * len(prefixes)

    def holds(path):
        node = np.array([0])
        for i in path:
            node = trie.step(node, np.array([i]))
        return node[0] >= 0

    assert all(holds(p) for p in prefixes)
    for p in list(prefixes)[:200]:
        for i in range(30):
            assert holds((*p, i)) == ((*p, i) in prefixes)
