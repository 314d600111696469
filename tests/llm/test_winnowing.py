import random
import re

import pytest

from threadsift.llm import winnowing

GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return [w for w in re.split(GAPS, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def brute_force(rows, items, window=10):
    wanted = [(i, words(t)) for i, t in items]
    out = []
    for i, t in rows:
        own, hit, found = words(t), set(), set()
        for item, w in wanted:
            n = min(len(w), window)
            windows = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
            for k in range(len(own) - n + 1) if n else ():
                if tuple(own[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found.add(item)
        out.append((str(i), len(own), len(hit), sorted(found)))
    return sorted(out)


def result(frame):
    return sorted((str(r.doc_id), r.n_words, sum(s.end - s.start for s in r.spans), list(r["items"])) for r in frame.collect())


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("broadcast", [400_000, -1])
def test_windows_of_all_sizes(spark, docs, monkeypatch, broadcast):
    monkeypatch.setattr("threadsift.llm.tables.BROADCAST_ROWS", broadcast)
    rng = random.Random(11)
    vocabulary = [*"ABCDEFGH", "Été", "été", "ΑΣ", "ας", "İx", "K9", "naïve"]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(prose(n))) for i, n in enumerate([30, 25, 12, 10, 9, 7, 4, 3, 11, 40])]
    items += [(20, items[0][1]), (21, None), (22, "!!"), (23, items[2][1] + " tail end"), (23, items[2][1])]
    rows = []
    for i in range(60):
        parts = [" ".join(prose(rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            own = words(rng.choice(items)[1])
            a = rng.randrange(max(1, len(own) - 8)) if own else 0
            parts += [", ".join(own[a : a + rng.randint(8, 20)]).upper(), " ".join(prose(rng.randint(0, 5)))]
        rows.append((i, ".\n".join(parts)))
    rows += [(100, None), (101, ""), (102, "?!"), (None, items[0][1]), (103, items[0][1] + " " + items[0][1]), rows[4], rows[4]]
    got = result(winnowing.contamination(docs(*rows), benchmark(spark, items)))
    assert got == brute_force(rows, items) and any(h for *_, h, _ in got)


def test_given_documents(spark, docs, small_documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    got = winnowing.contamination(docs(*small_documents), benchmark(spark, items))
    assert result(got) == brute_force(small_documents, items)


def test_clean_documents(spark, docs):
    item = " ".join(f"w{i}" for i in range(12))
    frame = docs((1, f"x {item} y"), (2, "clean"), (2, f"{item}"), (None, item), (None, "clean"), (3, None))
    left = winnowing.clean_documents(frame, benchmark(spark, [(1, item)]))
    assert left.columns == frame.columns
    assert sorted((str(r.doc_id), r.text or "") for r in left.collect()) == [("2", "clean"), ("3", ""), ("None", "clean")]


def test_empty_tables(spark, docs):
    assert winnowing.contamination(docs(), benchmark(spark, [(1, "a b c")])).collect() == []
    assert result(winnowing.contamination(docs((1, "a b")), benchmark(spark, []))) == [("1", 2, 0, [])]
    assert winnowing.clean_documents(docs((1, "a b")), benchmark(spark, [(1, None)])).count() == 1


def test_item_without_id(spark, docs):
    item = " ".join(f"w{i}" for i in range(12))
    frame, items = docs((1, f"x {item} y"), (2, "clean")), benchmark(spark, [(None, item), (5, "not in any of them")])
    assert result(winnowing.contamination(frame, items)) == [("1", 14, 12, []), ("2", 1, 0, [])]
    assert [r.doc_id for r in winnowing.clean_documents(frame, items).collect()] == [2]
