import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadsift.llm import lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def close_pairs(texts, edits):
    """All pairs of texts within reach, one way round. Only pairs whose lengths and counts of characters allow it are measured:
    an edit changes the length by one at most and the counts by two."""
    texts = sorted(texts, key=len)
    counts = np.zeros((len(texts), 64), np.int16)
    for k, t in enumerate(texts):
        np.add.at(counts[k], [ord(c) % 64 for c in t], 1)
    lengths = np.array([len(t) for t in texts])
    for k, t in enumerate(texts):
        end = np.searchsorted(lengths, len(t) + edits, "right")
        apart = np.abs(counts[k + 1 : end] - counts[k]).sum(axis=1)
        for j in np.flatnonzero(apart <= 2 * edits):
            if distance(t, texts[k + 1 + j]) <= edits:
                yield t, texts[k + 1 + j]


def brute_force(rows, edits=2, least=32, words=lines.EXACT_WORDS):
    takes_part = lambda x: len(x) >= least or (words is not None and len(re.findall(r"[^ \t\n\x0b\f\r]+", x)) >= words)
    places = [(i is None, i or 0, p, line) for i, t in rows if t is not None for p, line in enumerate(t.split("\n")) if takes_part(line)]
    first = {}
    for *place, line in places:
        first[line] = min(first.get(line, place), place)
    near = {a if first[b] < first[a] else b for a, b in close_pairs([x for x in first if len(x) >= least], edits)}
    out = []
    for i, t in rows:
        split = t.split("\n") if t is not None else []
        gone = [takes_part(x) and (x in near or [i is None, i or 0, p] > first[x]) for p, x in enumerate(split)]
        out.append((str(i), len(split), sum(gone), t if not any(gone) else "\n".join(x for x, g in zip(split, gone, strict=True) if not g)))
    return sorted(out, key=str)


def result(frame):
    return sorted(((str(r.doc_id), r._n_lines, r._n_removed, r.text) for r in frame.collect()), key=str)


def changed(rng, line, edits):
    out = list(line)
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(out) or 1)
        if kind == 0 or not out:
            out.insert(at, rng.choice("xyzé"))
        elif kind == 1:
            out.pop(at)
        else:
            out[at] = rng.choice("xyz😀")
    return "".join(out)


def test_edit_distance(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(1500):
        a = "".join(rng.choice("abé😀") for _ in range(rng.randint(1, 14)))
        b = changed(rng, a + "ab", rng.randint(0, 4))
        rows.append((a, b, distance(a, b)))
    pairs = spark.createDataFrame(rows, "a string, b string, d int").select("*", lines.code_points("a").alias("ca"), lines.code_points("b").alias("cb"))
    for edits in (0, 1, 2, 3):
        for measure in (lines.within_edits, lines.within_edits_trimmed):
            assert pairs.filter(measure(F.col("ca"), F.col("cb"), edits) != (F.col("d") <= edits)).count() == 0


@pytest.mark.parametrize(("edits", "block", "frequent"), [(2, 64, 10_000), (1, 64, 10_000), (3, 2, 4)])
def test_near_lines(docs, monkeypatch, edits, block, frequent):
    monkeypatch.setattr(lines, "BLOCK", block)
    monkeypatch.setattr(lines, "FREQUENT", frequent)
    rng = random.Random(edits)
    base = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(30, 70))) for _ in range(12)]
    rows = []
    for i in range(70):
        text = [changed(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3, 4])) for _ in range(rng.randint(0, 4))]
        rows.append((rng.randrange(1000) * 2, "\n".join([*text, "short", "", base[0]])))
    rows += [(i, "\n".join(x * 40 for x in "aab")) for i in (-5, 5)] + [(7, None), (9, ""), (None, base[1]), (None, base[1] + "\n" + base[1])]
    rows = list({r[0]: r for r in rows}.values())
    got = result(lines.without_repeated_lines(docs(*rows), edits=edits))
    assert got == brute_force(rows, edits)


@pytest.mark.parametrize(("hot", "levels", "block"), [(4, 4, 64), (4, 2, 3), (2, 5, 64), (1000, 4, 3)])
def test_lines_of_a_template(docs, monkeypatch, hot, levels, block):
    """Very many lines share a segment; they meet under finer keys, and at the last level in blocks."""
    for name, value in (("HOT", hot), ("LEVELS", levels), ("BLOCK", block)):
        monkeypatch.setattr(lines, name, value)
    rng = random.Random(hot)
    start, end = "Copyright notice, ", " by the authors."
    names = ["".join(rng.choice("abcdefgh") for _ in range(12)) for _ in range(25)]
    rows = []
    for i in range(60):
        some = [start + rng.choice(names) + end, start + "".join(rng.choice("xyz") for _ in range(rng.randint(3, 14))) + end]
        rows.append((i, "\n".join(changed(rng, x, rng.choice([0, 0, 1, 2, 3])) for x in some)))
    assert result(lines.without_repeated_lines(docs(*rows))) == brute_force(rows)


def test_pairs_of_a_template_grow_with_the_lines(spark, monkeypatch):
    """Lines with the same first 17 of 44 characters: what meets grows in proportion, not with the square."""
    import hashlib

    monkeypatch.setattr(lines, "HOT", 64)
    sizes = []
    for n in (400, 1600):
        texts = [("the same beginning" + hashlib.sha256(str(i).encode()).hexdigest())[:44] for i in range(n)]
        named = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "name long, line string").select("name", lines.wide("line").alias("_wide"))
        met = lines.meetings(named, 2, 32)
        sizes.append(met.agg(F.max("n"), F.sum(F.col("n") * F.col("n"))).first())
    assert all((s[0] or 0) <= 64 for s in sizes) and (sizes[1][1] or 0) <= 20 * max(400, sizes[0][1] or 0)


def test_repeated_rows_and_columns(docs):
    line = "a line that is long enough to take part in this"
    frame = docs((1, f"{line}\nx"), (1, f"{line}\nx"), (2, f"{line}\nx"))
    left = lines.without_repeated_lines(frame)
    assert left.columns == [*frame.columns, "_n_lines", "_n_removed"]
    assert [(r.doc_id, r.text) for r in left.orderBy("doc_id").collect()] == [(1, f"{line}\nx"), (1, f"{line}\nx"), (2, "x")]


def test_without_broadcast(docs, small_documents, monkeypatch):
    wide = result(lines.without_repeated_lines(docs(*small_documents)))
    monkeypatch.setattr("threadsift.llm.tables.BROADCAST_ROWS", -1)
    assert result(lines.without_repeated_lines(docs(*small_documents))) == wide == brute_force(small_documents)


def test_no_documents(docs):
    assert lines.without_repeated_lines(docs()).collect() == []


def test_short_lines_that_repeat(docs):
    """With a limit in words equal short lines go, near ones and trivial ones stay."""
    frame = docs((1, "All rights reserved.\n\nx\ntwo words"), (2, "All rights reserved.\n\nx\ntwo words"), (3, "All rights reserved!"), (4, "  All   rights "))
    left = lines.without_repeated_lines(frame, exact_words=3)
    got = {r.doc_id: (r.text, r._n_removed) for r in left.collect()}
    assert got[1] == ("All rights reserved.\n\nx\ntwo words", 0) and got[2] == ("\nx\ntwo words", 1)
    assert got[3] == ("All rights reserved!", 0) and got[4] == ("  All   rights ", 0)
    assert lines.without_repeated_lines(frame, exact_words=None).filter("_n_removed > 0").count() == 0


def test_different_texts_without_own_id(docs):
    """Of lines at the same place of different texts that have no doc_id, or the same one, the first stays."""
    line, other = "a line that is long enough to take part in this", "and another one that is just as long as it should be"
    texts = [f"{x}\n{i}" for x in (line, other) for i in range(5)]
    frame = docs(*((None if t.startswith(line) else 7, t) for t in texts), (None, f"{line}\n3"))
    left = [(r.doc_id, r.text, r._n_removed) for r in lines.without_repeated_lines(frame).collect()]
    for i, x in ((None, line), (7, other)):
        own = [(t, n) for d, t, n in left if d == i]
        stays = {t for t, n in own if n == 0}
        assert len(own) == (6 if i is None else 5) and len(stays) == 1 and all(t.startswith(x) for t in stays)
        assert all(n == 1 and "\n" not in t for t, n in own if t not in stays)
