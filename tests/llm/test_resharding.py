"""Resharding against the bounds of its flow and a linear search over all transfers."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadsift.llm import resharding
from threadsift.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def moved(flow):
    return int(flow.sum() - np.trace(flow))


@pytest.mark.parametrize("seed", range(20))
def test_flow_moves_the_least(seed):
    rng = np.random.default_rng(seed)
    n, m = rng.integers(1, 9, 2)
    sizes = rng.integers(0, 60, n)
    want = resharding.even(int(sizes.sum()), m)
    flow = resharding.transfers(sizes, want)
    assert (flow >= 0).all() and list(flow.sum(1)) == list(sizes) and list(flow.sum(0)) == want
    assert moved(flow) == sum(max(0, s - (want[i] if i < m else 0)) for i, s in enumerate(sizes))


@pytest.mark.parametrize("seed", range(10))
def test_flow_with_costs_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    sizes, cost = rng.integers(0, 6, 3), rng.integers(0, 9, (3, 2))
    want = resharding.even(int(sizes.sum()), 2)
    firsts = itertools.product(*[range(s + 1) for s in sizes])  # bytes of each old shard that go to the first new one
    least = min(sum(a * c[0] + (s - a) * c[1] for a, s, c in zip(f, sizes, cost, strict=True)) for f in firsts if sum(f) == want[0])
    assert (resharding.transfers(sizes, want, cost) * cost).sum() == least


def test_flow_refuses_too_little_room():
    with pytest.raises(ValueError, match="fewer bytes"):
        resharding.transfers([5, 5], [4, 4])


def check_layout(spark, docs, layout, shards):
    rows = resharding.read_layout(spark, layout).collect()
    size = lambda r: len((r.doc.text or "").encode()) + 1
    assert sorted(repr(r.doc) for r in rows) == sorted(map(repr, docs.collect()))
    assert all(r["size"] == size(r) for r in rows)
    for s in range(shards):
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))
    assert sum(r["size"] for r in rows if r.shard != r.old) == layout.moved_bytes
    return rows


@pytest.mark.parametrize(("old", "new", "block_rows"), [(6, 8, 1000), (6, 8, 7), (8, 3, 10), (1, 5, 10), (4, 4, 10)])
def test_layout_is_whole_even_and_moves_little(spark, tmp_path, old, new, block_rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    schema = resharding.store(docs.repartition(3), F.pmod(F.xxhash64("source"), F.lit(old)), str(tmp_path / "old"))
    layout = resharding.reshard(spark, str(tmp_path / "old"), schema, new, block_rows=block_rows)
    rows = check_layout(spark, docs, layout, new)
    sizes = [sum(r["size"] for r in rows if r.shard == s) for s in range(new)]
    mean, largest = sum(sizes) / new, max(r["size"] for r in rows)
    assert all(abs(s - mean) <= largest for s in sizes)
    assert abs(layout.moved_bytes - moved(layout.flow)) <= largest * new


def test_files_that_lose_nothing_stay(spark, tmp_path):
    docs = spark.range(90).select(F.col("id").alias("doc_id"), F.lit("x" * 9).alias("text"))
    shard = F.when(F.col("doc_id") < 50, 0).when(F.col("doc_id") < 70, 1).otherwise(2)
    schema = resharding.store(docs.repartition(10, "doc_id"), shard, str(tmp_path / "old"))
    layout = resharding.reshard(spark, str(tmp_path / "old"), schema, 3, block_rows=2)
    rows = check_layout(spark, docs, layout, 3)
    assert [sum(r.shard == s for r in rows) for s in range(3)] == [30, 30, 30]
    assert layout.moved_bytes == 200 and all("/old=0/" in f for f in layout.rewritten_files)
    assert len(layout.kept_files) > len(layout.rewritten_files) > 0


def test_odd_rows(spark, tmp_path):
    rows = [(None, None, 1, 1), (1, "", 2, 2), (1, "", 2, 2), (1, "ü" * 4000, 3, 3), (None, "y", 4, 4), (7, "z" * 3_000_000, 5, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, slot int")
    schema = resharding.store(docs, F.lit(0), str(tmp_path / "old"))
    layout = resharding.reshard(spark, str(tmp_path / "old"), schema, 3)
    found = check_layout(spark, docs, layout, 3)
    assert {r["size"] for r in found if r.doc.text in (None, "")} == {1}


def test_nothing(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    schema = resharding.store(docs, F.lit(0), str(tmp_path / "old"))
    layout = resharding.reshard(spark, str(tmp_path / "old"), schema, 4)
    assert resharding.read_layout(spark, layout).count() == 0


def test_query(spark, small_documents):
    rows = QUERIES["op13_resharding"](spark, SF).collect()
    texts = dict(small_documents)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) and r.law == "bytes" and r.grown_shard is None for r in rows)
    sizes = [sum(r["size"] for r in rows if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) < 0.02 * sum(sizes) / 8
