"""The Jaccard join, its trees and its components against brute force."""

import itertools
import random
import re

import numpy as np
import pytest

from threadsift.llm import components, jaccard
from threadsift.llm.sets import SignatureTree


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)] if words else [])


def joined(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def linked(x, y):
    return bool(x) and bool(y) and 100 * len(x & y) >= 75 * len(x | y)


def brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if linked(sets[i], sets[j])]
    groups = joined(len(rows), pairs)
    least = {}
    for (i, _), g in zip(rows, groups, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return sorted((i is None, i or 0, len(s), -1 if least.get(g) is None else least[g]) for (i, _), s, g in zip(rows, sets, groups, strict=True))


def result(frame):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in frame.collect())


def family(rng, words, copies, edits):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    for _ in range(copies):
        text = list(base)
        for _ in range(edits):
            text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        yield " ".join(text)


def test_given_documents(docs, small_documents):
    assert result(jaccard.near_components(docs(*small_documents))) == brute_force(small_documents)


@pytest.mark.parametrize("tile_bytes", [1 << 22, 6000])
def test_families_and_odd_rows(docs, tile_bytes):
    rng = random.Random(5)
    texts = [t for words, copies, edits in ((60, 30, 1), (60, 25, 2), (200, 12, 4), (9, 6, 1)) for t in family(rng, words, copies, edits)]
    shared = " ".join(f"s{i}" for i in range(40))
    texts += [f"{shared} {next(family(rng, 30, 1, 0))}" for _ in range(20)]  # a passage alone links nothing
    texts += ["A b", "a B", "a b c", None, "", " \t\n", "same", "same"]
    rows = list(enumerate(texts, 10))
    rng.shuffle(rows)
    rows += [rows[0], rows[0], (None, rows[1][1]), (None, "alone without id"), (None, None)]
    assert result(jaccard.near_components(docs(*rows), tile_bytes=tile_bytes)) == brute_force(rows)


def test_boundary_of_three_quarters(docs):
    base = [f"w{i}" for i in range(11)]  # 7 shingles
    rows = [(1, " ".join(base)), (2, " ".join([*base, "x"])), (3, " ".join([*base, "x", "y", "z"])), (4, " ".join([*base, "x", "y"]))]
    assert result(jaccard.near_components(docs(*rows))) == brute_force(rows)


def test_no_documents(docs):
    assert jaccard.near_components(docs()).collect() == [] and jaccard.one_of_each(docs()).collect() == []


def test_one_of_each(docs):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(5, text), (3, text), (3, text), (7, text + " more"), (None, text), (None, "other"), (8, None), (9, "")]
    frame = docs(*rows)
    left = jaccard.one_of_each(frame)
    assert left.columns == frame.columns
    assert sorted((str(r.doc_id), r.text or "") for r in left.collect()) == [("3", text), ("8", ""), ("9", ""), ("None", "other")]


def test_tree_joins_what_brute_force_joins():
    rng = np.random.default_rng(3)
    for trial in range(60):
        bases = [np.unique(rng.integers(0, 2**62, rng.integers(1, 60)).astype(np.uint64)) for _ in range(4)]
        sets = []
        for _ in range(rng.integers(2, 70)):
            base = bases[rng.integers(0, 4)]
            kept = base[rng.random(len(base)) > rng.choice([0, 0.05, 0.15, 0.3])]
            sets.append(np.unique(np.concatenate((kept, rng.integers(0, 2**62, rng.integers(1, 5)).astype(np.uint64)))))
        sizes = np.array([len(s) for s in sets])
        side = rng.integers(0, 2, len(sets))
        across = trial % 2
        tree = SignatureTree(np.arange(len(sets)), sizes, sets, np.arange(len(sets)) if across else None, side if across else None)
        links = {(int(tree.names[a]), int(tree.names[b])) for a, b in tree.join(75)}
        want = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if linked(set(sets[i].tolist()), set(sets[j].tolist()))]
        assert {tuple(sorted(x)) for x in links} <= set(want)
        assert joined(len(sets), links) == joined(len(sets), want)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500)]
    want = joined(501, edges)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    touched = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: want[x] for x in touched}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_without_own_id(docs):
    """One row of a group stays though none has a doc_id, or several texts have the same one."""
    text, other = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(None, text + end) for end in ("", " more", " most", "")] + [(4, other), (4, other + " too"), (None, other), (None, None), (None, "alone")]
    left = sorted((str(r.doc_id), r.text or "") for r in jaccard.one_of_each(docs(*rows)).collect())
    assert [i for i, _ in left] == ["4", "None", "None", "None"]
    assert sorted(t[:3] for _, t in left) == ["", "a0 ", "alo", "b0 "]
