"""Hard negatives against all inner products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadsift.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<double>, block int, at string, score int"


def brute_force(rows, every=50):
    v = [(i, lab, [math.floor(x * 256) for x in vec]) for i, lab, vec in rows
         if lab is not None and vec is not None and all(x is not None and math.isfinite(x) for x in vec)]
    out = []
    for k, (anchor, label, a) in enumerate(v):
        if anchor is None or anchor % every:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b, strict=False)), i is None, i or 0, i, lab) for n, (i, lab, b) in enumerate(v) if n != k]
        scores.sort(key=lambda s: s[:3])
        for ps, _, _, positive, _ in [s for s in scores if s[4] == label][:5]:
            fitting = [s for s in scores if s[4] != label and 50 * -ps <= 100 * -s[0] <= 95 * -ps]
            out += [(anchor, positive, n + 1, s[3], -ps, -s[0]) for n, s in enumerate(fitting[:3])]
    return sorted(map(repr, out))


def mined(spark, rows, every=50):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    df = df.filter(negatives.usable(F.col("label"), F.col("embedding")))
    df = df.select("vec_id", F.col("label").cast("long").alias("label"), negatives.whole_numbers(F.col("embedding")).alias("q"), "block", "at")
    return sorted(repr(tuple(r)) for r in negatives.hard_negatives(df, every).collect())


@pytest.fixture
def small(monkeypatch):
    for name, value in (("GROUP", 2), ("TILE", 3)):
        monkeypatch.setattr(negatives, name, value)
    plain = negatives.blocks_of
    monkeypatch.setattr(negatives, "blocks_of", lambda rows, shape: plain(rows, shape, 4))


@pytest.mark.parametrize("kind", ["independent", "clustered", "tied"])
def test_equals_brute_force(spark, small, kind):
    r = np.random.default_rng(3)
    x = r.normal(size=(160, 6)) / 3
    if kind == "clustered":
        x = r.normal(size=(8, 6))[r.integers(0, 8, 160)] + x / 10
    if kind == "tied":
        x = r.integers(-1, 2, (160, 6)) / 4
    rows = [(i, int(r.integers(0, 4)), [float(c) for c in v]) for i, v in enumerate(x)]
    assert mined(spark, rows, 20) == brute_force(rows, 20) != []


def test_odd_rows(spark, small):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (None, 1, [0.9, 0.4]), (2, None, [1.0, 1.0]), (3, 1, None), (4, 2, [1.0, None]),
            (5, 2, [nan, 1.0]), (6, 2, [1.0, inf]), (7, 2, [0.6, 0.4]), (8, 3, [0.7]), (9, 3, []), (None, 2, [0.7, 0.2]), (50, 9, [1.0, 1.0]),
            (100, 2, [-1.0, -1.0]), (100, 2, [-1.0, -1.0]), (150, 4, [0.0, 0.0]), (151, 4, [0.3, 0.0])]
    assert mined(spark, rows) == brute_force(rows) != []


def test_hot_vector_and_large_components(spark, small):
    rows = [(i, i % 2, [3.0e4, -2.5e4, 1.0]) for i in range(60)] + [(60 + i, 1 - i % 2, [2.0e4, -2.4e4, float(i)]) for i in range(20)]
    assert mined(spark, rows) == brute_force(rows) != []


def test_nothing_and_too_much(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [])]) == []
    with pytest.raises(ValueError, match="64 bits"):
        mined(spark, [(0, 1, [1e9, 1.0]), (1, 1, [1e9, 1.0])])


def test_curve_visits_neighbours():
    for n, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.array(np.meshgrid(*[range(1 << bits)] * n)).reshape(n, -1).T
        keys = negatives.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        walk = cells[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_zones_spare_blocks_of_clustered_vectors(spark, monkeypatch):
    """Of vectors in clusters less than half of all pairs of anchor and block are read."""
    r = np.random.default_rng(1)
    centres = r.normal(size=(10, 8))
    rows = [(i, int(r.integers(0, 3)), (centres[i % 10] + r.normal(size=8) / 30).tolist()) for i in range(1000)]
    asked, plain = [], negatives.settled
    monkeypatch.setattr(negatives, "settled", lambda df, name: (out := plain(df, name), asked.append(out) if name == "asked" else None)[0])
    monkeypatch.setattr(negatives, "BLOCK", 16)
    monkeypatch.setattr(negatives.blocks_of, "__defaults__", (16,))
    assert mined(spark, rows) == brute_force(rows)
    pairs = [sum(bin(int.from_bytes(r.need, "big")).count("1") for r in df.collect()) for df in asked]
    assert sum(pairs) < 0.5 * 20 * (1000 / 16)
