import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from threadsift.llm import fingerprints
from threadsift.llm.hashing import flat


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(rows):
    order = sorted(((i is None, i or 0, t or "") for i, t in rows))
    texts = [t for *_, t in order]
    out = []
    for k, (none, i, t) in enumerate(order):
        n = len(t) // 4
        out.append((None if none else i, t, t[: len(t) - n] + texts[(k + 1) % len(texts)][:n], texts[(k + 1) % len(texts)]))
    return out


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_edited_neighbours(spark, docs, small_documents, partitions):
    rows = [*small_documents, (500, None), (501, ""), (502, "é😀 " * 400), (502, "é😀 " * 400), (None, "last of all by its place"), (None, None)]
    random.Random(1).shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = fingerprints.edited_neighbours(docs(*rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = edited(rows)
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == sorted(
        ((i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in want), key=key
    )
    by_id = {r.doc_id: r for r in got}
    off = [by_id[i].near_edited - jaccard(shingles(t), shingles(e)) for i, t, e, _ in want if i in by_id and i not in (None, 502)]
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.06
    assert all(abs(by_id[i].near_next - jaccard(shingles(t), shingles(n))) < 0.2 for i, t, _, n in want if i not in (None, 502))
    assert by_id[500].fingerprint == by_id[501].fingerprint != by_id[502].fingerprint


@pytest.mark.parametrize("rows", [[], [(3, "only one document here")], [(None, None)]])
def test_few_documents(docs, rows):
    got = fingerprints.edited_neighbours(docs(*rows)).collect()
    assert [(r.doc_id, r.n_chars) for r in got] == [(i, len(t or "")) for i, t in rows]


def test_equal_texts_have_equal_fingerprints():
    texts = pa.array(["a b c d e f", "A  B c\nd e f", "a b c d e f", "", None, "x"])
    sig = fingerprints.signatures(*flat(texts))
    assert (sig[0] == sig[1]).all() and (sig[0] == sig[2]).all() and (sig[3] == sig[4]).all() and (sig[3] != sig[5]).any()


def test_near_duplicates(docs):
    rng = random.Random(3)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows, base = [], words(200)
    for i in range(30):
        text = list(base if i < 20 else words(200))
        text[rng.randrange(200)] = "changed"
        rows.append((i, " ".join(text)))
    rows += [(40, rows[25][1]), (41, rows[25][1]), (42, None), (43, ""), (44, ""), (None, rows[0][1])]
    links = [(r.a, r.b, r.jaccard) for r in fingerprints.near_duplicates(docs(*rows)).collect()]
    sets = {i: shingles(t) for i, t in rows if i is not None}
    assert all(a < b and j >= 0.75 and abs(j - jaccard(sets[a], sets[b])) < 1e-9 for a, b, j in links)
    root = {i: i for i in sets}
    for a, b, _ in sorted(links):
        old, new = root[b], root[a]
        root = {k: (new if v == old else v) for k, v in root.items()}
    groups = {}
    for i, r in root.items():
        groups.setdefault(r, set()).add(i)
    assert sorted(map(sorted, (g for g in groups.values() if len(g) > 1))) == [list(range(20)), [25, 40, 41]]


@pytest.mark.parametrize("block", [None, 16])
def test_near_duplicates_behind_other_heads(docs, monkeypatch, block):
    """A passage and its near copy are linked though longer documents that quote it come first in all of their bands."""
    if block:
        monkeypatch.setattr(fingerprints, "BLOCK", block)
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = words(200)
    rows = [(i, " ".join(passage + words(80))) for i in range(400)]
    rows += [(1000, " ".join(passage)), (1001, " ".join([*passage[:190], *words(10)]))]
    links = [(r.a, r.b, r.jaccard) for r in fingerprints.near_duplicates(docs(*rows)).collect()]
    sets = {i: shingles(t) for i, t in rows}
    assert all(a < b and j >= 0.75 and abs(j - jaccard(sets[a], sets[b])) < 1e-9 for a, b, j in links)
    root = {i: i for i in sets}
    for a, b, _ in links:
        old, new = root[b], root[a]
        root = {k: (new if v == old else v) for k, v in root.items()}
    assert root[1000] == root[1001]
    assert len(set(root.values())) == 401
