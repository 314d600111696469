"""The prefix trie against one built turn by turn."""

import hashlib
import re
import zlib

import pytest

from threadsift.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, id string, parent int, next int, c int"


def brute_force(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    nodes = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt = own.get(c - c % 20, [])[:h] + own[c][h:]
        for d in range(len(rebuilt) + 1):
            node = nodes.setdefault(tuple(rebuilt[:d]), {"members": [], "ends": []})
            node["members"].append(c)
            if d == len(rebuilt):
                node["ends"].append(c)
    children = {}
    for k in nodes:
        if k:
            children.setdefault(k[:-1], []).append(k)
    totals = {}
    for k in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        below = [totals[x] for x in children.get(k, ())]
        totals[k] = (sum(b[0] for b in below) + (not below), sum(b[1] for b in below) + (len(nodes[k]["members"]) - 1) * words)
    out = []
    for k, n in nodes.items():
        parent = min(nodes[k[:-1]]["members"]) if k else None
        ends = hashlib.sha256(",".join(map(str, sorted(n["ends"]))).encode()).hexdigest()
        out.append((min(n["members"]), len(k), parent, len(n["members"]), len(children.get(k, ())), *totals[k], ends))
    return sorted(map(repr, out))


def built(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)
    return sorted(repr(tuple(r)) for r in trie.prefix_trie(df).collect())


def test_random_conversations(spark):
    import random

    r = random.Random(5)
    rows = []
    for c in r.sample(range(130), 60):
        for t in range(r.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, t, r.choice("ab"), r.choice(["one two", "three", "", " four  five\tsix "])))
    rows += [(40, t, "a", f"turn {t} of a long one") for t in range(9, 60)]
    assert built(spark, rows) == brute_force(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "a", "nobody"), (7, None, "a", "first"), (7, 0, None, None), (7, 0, "b", "tie"), (7, 0, "a", "tie"), (7, 5, "b", "x"),
            (7, 5, "b", "x"), (8, None, None, None), (9, 3, "a", "long " * 400_000), (29, 3, "a", "long " * 400_000),
            (20, 1, "", "only one"), (21, 1, "a", "z"), (22, 1, "a", "z"), (23, 4, "a", "z")]
    assert built(spark, rows) == brute_force(rows)


def test_nothing(spark):
    assert built(spark, []) == []


def test_places_in_chunks(spark):
    rows = [(c, i, "a", f"{i % 3}" if i > 4 else f"{c}") for c in (1, 2, 41) for i in range(30)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns, convs = trie.rebuilt_turns(df)
    want = sorted(tuple(r) for r in trie.nodes_and_ends(turns, convs)[0].collect())
    assert sorted(tuple(r) for r in trie.nodes_and_ends(turns, convs, chunk=3)[0].collect()) == want


@pytest.mark.parametrize("shape", ["path", "star", "caterpillar", "binary"])
def test_totals_of_shapes(spark, shape):
    n = 200
    parent = {"path": lambda i: i - 1, "star": lambda i: 0, "caterpillar": lambda i: i - 1 if i % 2 else max(0, i - 2), "binary": lambda i: (i - 1) // 2}[shape]
    above = {i: parent(i) if i else None for i in range(n)}
    key = lambda i: None if i is None else i.to_bytes(4, "big")
    rows = [(key(i), key(above[i]), i % 3, i) for i in range(n)]
    totals = {i: [i % 3, i] for i in range(n)}
    for i in range(n - 1, 0, -1):
        for k in (0, 1):
            totals[above[i]][k] += totals[i][k]
    nodes = spark.createDataFrame(rows, "id binary, parent binary, leaves long, saved long")
    got = {int.from_bytes(r.id, "big"): [r.leaves, r.saved] for r in trie.subtree_totals(nodes).collect()}
    assert got == totals


def test_many_ends_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 50)
    ids = list(range(1, 400))
    df = spark.createDataFrame([(b"n", i) for i in ids] + [(b"m", 5)], "id binary, c long")
    got = {bytes(r.id): r.ends_sha256 for r in trie.end_digests(df).collect()}
    assert got == {b"n": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), b"m": hashlib.sha256(b"5").hexdigest()}
