"""The prefix trie against brute force over rebuilt conversations."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pandas as pd
import pytest

pytest.importorskip("touchline.llm")

from touchline.llm import prefix_trie  # noqa: E402
from touchline.llm.staging import Staging  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string, depth int, node string, part long"


def brute(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, (r or "").encode(), (x or "").encode()))
    known = {c: [v[2:] for v in sorted(vs)] for c, vs in turns.items()}
    made = {}
    for c, own in known.items():
        h, rest = zlib.crc32(str(c).encode()) % 4, abs(c) % 20
        made[c] = tuple(known.get(c - rest if c >= 0 else c + rest, [])[:h] + own[h:])
    members, below, total = defaultdict(list), defaultdict(list), {}
    for c, v in made.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    for p in members:
        if p:
            below[p[:-1]].append(p)
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(rb"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        total[p] = (sum(total[k][0] for k in below[p]) or 1, (len(members[p]) - 1) * words + sum(total[k][1] for k in below[p]))
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(below[p]), *total[p], hashlib.sha256(
        ",".join(str(c) for c in sorted(m) if len(made[c]) == len(p)).encode()).hexdigest()) for p, m in members.items()), key=str)


def check(spark, rows):
    df = spark.createDataFrame([(*r, 7, "x", 3) for r in rows], SCHEMA).repartition(5)
    got = prefix_trie.build(df)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("local", [40, prefix_trie.LOCAL])
def test_trie(spark, monkeypatch, local):
    monkeypatch.setattr(prefix_trie, "LOCAL", local)
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["u", "a", None]), rng.choice(["x y", "z", None, "", "q  w\te"]))
            for c in [*range(-25, 40), 100, 101, 119, None] for t in [None] * rng.randint(0, 2) + list(range(rng.randint(0, 5)))]
    rows += rows[:9]  # repeated rows
    check(spark, rows)


def test_long_conversations(spark, monkeypatch):
    """Deep unary paths, one turn repeated in one place, turns beyond a block."""
    monkeypatch.setattr(prefix_trie, "LOCAL", 1500)
    rows = [(40, t, "u", str(t % 3)) for t in range(1300)] + [(41, t, "u", str(t % 3)) for t in range(1200)]
    check(spark, rows + [(47, 7, "u", "same")] * 1100 + [(46, 7, "u", "same")] * 90 + [(21, 0, "u", "alone")])


def test_same_conversation_many_times(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 16)
    check(spark, [(20 * c, t, "u", f"turn {t}") for c in range(70) for t in range(3)])


def test_empty(spark):
    assert prefix_trie.build(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("shape, local", [("path", 6), ("path", 10**6), ("star", 1), ("random", 9), ("random", 10**6)])
def test_subtree_totals(spark, monkeypatch, shape, local):
    monkeypatch.setattr(prefix_trie, "LOCAL", local)
    rng = random.Random(3)
    n = 60
    parent = [None] + [{"path": k - 1, "star": 0, "random": rng.randrange(k)}[shape] for k in range(1, n)]
    depth, below = [0] * n, [1] * n
    for k in range(1, n):
        depth[k] = depth[parent[k]] + 1
    value = [rng.randint(0, 9) for _ in range(n)]
    total = list(value)
    for k in range(n - 1, 0, -1):
        total[parent[k]] += total[k]
        below[parent[k]] += below[k]
    nodes = spark.createDataFrame([(k, parent[k], k, depth[k], below[k], value[k]) for k in range(n)],
                                  "node long, parent long, conv_id long, depth long, weight long, v long")
    path = []
    for k in range(n):
        at = k
        while at is not None:
            path.append((k, depth[at], at, parent[at]))
            at = parent[at]
    path = spark.createDataFrame(path, "conv_id long, depth long, node long, parent long")
    got = prefix_trie.subtree_totals(nodes, path, ["v"], Staging(spark, "totals"))
    assert {r.node: r.v for r in got.collect()} == dict(enumerate(total))


def test_components_over_several_batches():
    """Rows sorted by component, a component in three batches, among them an empty one."""
    part, parent = [-1, 5, 5, 5, 5, 8], [-1, 0, 1, 2, 2, 9]
    rows = pd.DataFrame({"node": range(6), "parent": parent, "part": part, "weight": [1, 4, 3, 1, 1, 1],
                         "v": [1, 2, 4, 8, 16, 32], "add_v": [100, 0, 0, 0, 0, 0]})
    batches = [rows.iloc[:2], rows.iloc[:0], rows.iloc[2:4], rows.iloc[4:]]
    got = pd.concat(prefix_trie.settled(["v"], ["add_v"])(iter(batches)))
    assert dict(zip(got["node"], got["v"], strict=True)) == {0: 101, 1: 30, 2: 28, 3: 8, 4: 16, 5: 32}
