"""Months are cut by their measured sizes."""

import glob
from collections import Counter

import pytest
from pyspark.sql import functions as F

from threadsift import JobOptions, run_job
from threadsift.operators.layout import Pieces, measured_pieces
from threadsift.plans import job
from threadsift.sources.writers import write_feed_json
from workload.feed import comment_feed

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture
def small_files(spark):
    values = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "50k",
        "spark.sql.shuffle.partitions": "2500",  # beyond it Spark only knows average sizes
    }
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def files_per_month(table):
    return Counter(p.split("/year=")[1].rpartition("/")[0] for p in glob.glob(f"{table}/**/part-*.parquet", recursive=True))


def test_pieces_are_looked_up_by_month(spark):
    rows = spark.createDataFrame([(2012, 1), (2012, 2), (1970, 1), (9999, 12), (-400, 1), (None, None)], "year int, month int")
    known = {(2012, 1): 7, (2011, 3): 2, (None, None): 5}
    for far in ({}, {(250000, 1): 3}):
        column = Pieces(4, known | far).column()
        assert [r[0] for r in rows.select(column).collect()] == [7, 4, 4, 4, 4, 5]
    assert [r[0] for r in rows.select(Pieces().column()).collect()] == [1] * 6


def test_pieces_hold_one_or_two_files(spark):
    size = 2 * (64 << 20)
    found = measured_pieces(spark, {(2012, 1): 10 * size, (2012, 2): 3, (None, None): size + 1})
    assert found.by_month == {(2012, 1): 10, (2012, 2): 1, (None, None): 2} and found.default == 10
    assert measured_pieces(spark, {}).default == 8


def test_small_months_are_one_file_each(spark, tmp_path):
    job.transform(comment_feed(spark, "/root/testdata/sf0.1"), str(tmp_path / "t"))
    assert set(files_per_month(tmp_path / "t").values()) == {1}
    assert len(files_per_month(tmp_path / "t")) == 80


@pytest.mark.parametrize("files", [8, 40])
def test_a_large_month_is_split_and_small_ones_are_not(spark, small_files, tmp_path, files):
    hot = F.when(F.crc32("id") % 3 > 0, "1325376000").otherwise(F.col("created_utc"))
    write_feed_json(comment_feed(spark, MEDIUM).withColumn("created_utc", hot).repartition(files), str(tmp_path / "feed"))
    result = run_job(spark, str(tmp_path / "feed"), str(tmp_path / "out"), JobOptions())
    assert result, result.error
    found = files_per_month(result.paths.analytical)
    assert found.pop("2012/month=1") > 4
    if files == 8:  # all of them are sampled
        assert max(found.values()) <= 2
    assert job.read_table(spark, str(tmp_path / "out")).count() == result.quality.metrics["transformation"]["final_records"]


def test_compaction_cuts_by_stored_sizes(spark, small_files, tmp_path):
    feed = comment_feed(spark, MEDIUM)
    for k in range(3):
        write_feed_json(feed.filter(F.crc32("id") % 3 == k), str(tmp_path / f"f{k}"))
        assert run_job(spark, str(tmp_path / f"f{k}"), str(tmp_path / "out"), JobOptions(mode="append"))
    run = job.compact(spark, str(tmp_path / "out"))
    assert set(files_per_month(job.Paths(str(tmp_path / "out"), run).analytical).values()) == {1}
