"""Batch ingest, the row limit and the stream, against each other and brute force."""

import json
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from conftest import SMALL, plan_of
from threadsift.operators import clean as c
from threadsift.operators import features as f
from threadsift.plans import job
from threadsift.operators.quality import QualityMetrics
from threadsift.sources.limit import find_cut, read_to_cut
from threadsift.sources.readers import read_analytical, read_feed, stored_files
from threadsift.streaming import ingest as s
from workload.feed import comment_feed


def bag(df):
    return sorted(map(repr, df.collect()))


def write_file(path, rows):
    with open(path, "w", encoding="utf-8") as out:
        for row in rows:
            out.write((row if isinstance(row, str) else json.dumps(row)) + "\n")


@pytest.fixture
def folder(tmp_path):
    return fill(tmp_path / "a folder", "f{}.json")


@pytest.fixture
def odd_folder(tmp_path):
    """The same rows under names that hold pattern and escape characters."""
    fill(tmp_path / "a folder {1}", "f[{}] 100%25.json")
    return str(tmp_path / "a folder*")


def fill(path, name):
    """Five files with 0, 3, 4, 0 and 5 rows to keep, after 1, 2, 3, 4 and 4 rows to drop."""
    path.mkdir()
    n = 0
    for i, kept in enumerate([0, 3, 4, 0, 5]):
        rows = [{"id": None, "body": ""}, {"body": "[removed]"}, {"id": "z"}, "{bad"][: i + 1]
        for _ in range(kept):
            rows.append({"id": f"k{n}", "body": f"text {n}", "score": n, "created_utc": 1325376000 + n})
            n += 1
        write_file(path / name.format(i), rows)
    return str(path)


# five empty and three absent texts, a placeholder in all files but the first, two bad lines
DROPPED = {c.CORRUPT_RECORD: 2, c.NULL_BODY: 8, c.PLACEHOLDER: 4}


def cut_of(spark, source, limit):
    feed = job._Source(spark, str(source), job.JobOptions())
    return feed, find_cut(feed.tagged, stored_files(spark, str(source)), limit)


@pytest.mark.parametrize("limit", [1, 2, 3, 4, 6, 7, 8, 11, 12, 13, 100])
@pytest.mark.parametrize("names", ["folder", "odd_folder"])
def test_limit_takes_the_first_files(spark, request, names, limit):
    feed, cut = cut_of(spark, request.getfixturevalue(names), limit)
    got = [r["id"] for r in read_to_cut(spark, feed.kept, cut).collect()]
    assert len(got) == len(set(got)) == min(limit, 12)
    whole = 0 if limit < 3 else 3 if limit < 7 else 7 if limit < 12 else 12
    assert {f"k{i}" for i in range(whole)} <= set(got)


@pytest.mark.parametrize("limit", [1, 500, 1234, 1999, 2000])
def test_limit_inside_a_file_shuffles_one_block(spark, tmp_path, monkeypatch, limit):
    """A file of 40 blocks: what passes through the limit is in one of them."""
    limited, plain = [], DataFrame.limit
    monkeypatch.setattr(DataFrame, "limit", lambda df, n: limited.append((df, n)) or plain(df, n))
    write_file(tmp_path / "one.json", [{"id": f"k{i:04}", "body": "x" * 100} for i in range(2000)])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    size = (tmp_path / "one.json").stat().st_size
    for key in before:
        spark.conf.set(key, str(size // 40 + 1))
    try:
        feed, cut = cut_of(spark, tmp_path / "one.json", limit)
        rows = read_to_cut(spark, feed.kept, cut)
        got = [r["id"] for r in rows.collect()]
        assert got and len(got) == len(set(got)) == limit
        within = [(df.count(), n) for df, n in limited if "id" in df.columns]
        assert len(within) == (limit < 2000) and all(n <= held <= 60 for held, n in within)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    # which rows were taken is settled before any later stage reads them
    assert "Limit" not in plan_of(rows, "simple")


def test_limit_prunes_files_when_listing(spark, folder):
    feed, cut = cut_of(spark, folder, 8)
    whole = read_to_cut(spark, feed.kept, replace(cut, cut=None))
    assert "file_path" in plan_of(whole) and whole.count() == 7


@pytest.mark.parametrize("limit", [0, -1])
def test_limit_must_be_positive(spark, folder, limit):
    with pytest.raises(ValueError, match="positive"):
        cut_of(spark, folder, limit)


def test_limit_stops_counting_at_the_cut(spark, folder):
    _, cut = cut_of(spark, folder, 2)
    assert cut.last_whole.endswith("f0.json") and cut.rows_of_cut == 2
    # files 0 and 1: an empty text each, a placeholder in the second, three rows to keep
    assert cut.counts == {"rows_read": 6, c.CORRUPT_RECORD: 0, c.NULL_BODY: 2, c.PLACEHOLDER: 1}


@pytest.mark.parametrize("limit", [None, 5, 12, 99])
def test_ingest_lands_kept_rows_and_counts(spark, folder, tmp_path, limit):
    quality = QualityMetrics()
    landed = str(tmp_path / "landed")
    job.ingest(spark, folder, landed, job.JobOptions(limit=limit), quality)
    got = [r["id"] for r in read_feed(spark, landed).collect()]
    want = 12 if limit is None else min(limit, 12)
    assert len(set(got)) == len(got) == want
    metrics = quality.metrics["extraction"]
    assert metrics["total_records"] == want and metrics["file_size_mb"] >= 0
    if limit is None:
        assert {k: metrics[k] for k in DROPPED} == DROPPED


def test_ingest_of_nothing_with_a_limit(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_file(tmp_path / "in" / "a.json", [{"body": ""}])
    job.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), job.JobOptions(limit=3), QualityMetrics())
    assert read_feed(spark, str(tmp_path / "out")).count() == 0


def test_ingest_replaces_its_target(spark, folder, tmp_path):
    landed = str(tmp_path / "landed")
    for _ in range(2):
        job.ingest(spark, folder, landed)
    assert read_feed(spark, landed).count() == 12


def land(spark, source, landed, checkpoint):
    stream = s.stream_ingest_clean(s.stream_feed(spark, source, files_per_batch=2))
    return s.finish(s.start_landing(stream, landed, checkpoint))


def test_stream_equals_batch_over_several_drops(spark, tmp_path):
    feed = comment_feed(spark, SMALL).withColumn("drop", F.crc32("id") % 3)
    source, landed, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    seen = 0
    for drop in range(3):
        part = feed.filter(F.col("drop") == drop).drop("drop").repartition(3)
        part.write.mode("append").json(source, ignoreNullFields=False)
        counts = land(spark, source, landed, checkpoint)
        seen += counts["rows_read"]
        assert counts["rows_read"] == part.count()
        want = c.ingest_clean(read_feed(spark, source))
        assert bag(read_feed(spark, landed).drop("_corrupt_record")) == bag(want)
    assert seen == feed.count()
    # nothing new, nothing done
    assert land(spark, source, landed, checkpoint).get("rows_read", 0) == 0


def test_stopped_stream_goes_on_where_it_was(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    feed = comment_feed(spark, SMALL)
    feed.repartition(12).write.json(source, ignoreNullFields=False)

    def start():
        stream = s.stream_analytical(s.stream_feed(spark, source, files_per_batch=1), drop_empty=False)
        return s.start_analytical(stream, table, checkpoint)

    first = start()
    while first.isActive and not first.recentProgress:
        time.sleep(0.05)
    first.stop()
    s.finish(start())
    assert bag(read_analytical(spark, table)) == bag(f.analytical_table(feed))


def test_stream_counters_cover_every_micro_batch(spark, folder, tmp_path):
    counts = land(spark, folder, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert counts == {"rows_read": 26, **DROPPED}


def test_stream_table_equals_batch_table(spark, tmp_path, zone):
    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    comment_feed(spark, SMALL).repartition(5).write.json(source, ignoreNullFields=False)
    stream = s.stream_analytical(s.stream_feed(spark, source, files_per_batch=2), drop_empty=False)
    counts = s.finish(s.start_analytical(stream, table, str(tmp_path / "cp")))
    assert counts["rows_read"] == 200
    assert bag(read_analytical(spark, table)) == bag(f.analytical_table(read_feed(spark, source)))


def test_stream_splits_a_hot_month(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "100k")
    try:
        source, table = str(tmp_path / "in"), str(tmp_path / "table")
        hot = comment_feed(spark, "/root/testdata/sf0.01").withColumn("created_utc", F.lit("1325376000"))
        hot.repartition(8).write.json(source, ignoreNullFields=False)
        stream = s.stream_analytical(s.stream_feed(spark, source))
        s.finish(s.start_analytical(stream, table, str(tmp_path / "cp")))
        assert len(list((tmp_path / "table" / "year=2012" / "month=1").glob("part-*.parquet"))) > 2
    finally:
        spark.conf.set(key, before)


def test_stream_of_parquet(spark, tmp_path):
    source = str(tmp_path / "in")
    feed = comment_feed(spark, SMALL)
    feed.write.parquet(source)
    stream = s.stream_feed(spark, source, "parquet", parquet_schema=feed.schema)
    s.finish(s.start_landing(s.stream_ingest_clean(stream), str(tmp_path / "out"), str(tmp_path / "cp")))
    assert read_feed(spark, str(tmp_path / "out")).count() == c.ingest_clean(feed).count()


def test_stream_refuses_names_that_spark_reads_twice(spark, odd_folder):
    with pytest.raises(ValueError, match="pattern"):
        s.stream_feed(spark, odd_folder)


def test_stream_bounded_by_bytes(spark, folder, tmp_path):
    stream = s.stream_ingest_clean(s.stream_feed(spark, folder, bytes_per_batch=300))
    query = s.start_landing(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert s.finish(query) == {"rows_read": 26, **DROPPED}
    assert len(query.recentProgress) > 2
