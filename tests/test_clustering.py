"""A clustered table: what a look-up of one group reads."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from threadsift import JobOptions, run_job
from threadsift.plans import job
from threadsift.sources.writers import write_feed_json
from workload.feed import comment_feed

LARGE = "/root/testdata/sf0.1"


def one_month(spark):
    return comment_feed(spark, LARGE).withColumn("created_utc", F.expr("cast(1325376000 + crc32(id) % 2000000 as string)"))


def rows_scanned(df):
    """Rows that the scan has given out, by its own metric."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def row_groups(table):
    """(group of the first and last row, columns with a Bloom filter) of each row group of the hot month."""
    found = []
    for path in glob.glob(f"{table}/year=2012/month=1/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        for k in range(meta.num_row_groups):
            at = next(c for c in range(meta.num_columns) if meta.row_group(k).column(c).path_in_schema == "subreddit")
            found.append(meta.row_group(k).column(at).statistics)
    return found


@pytest.fixture
def stored(spark, tmp_path):
    write_feed_json(one_month(spark).repartition(4), str(tmp_path / "feed"))
    paths = {}
    for name, options in (("plain", JobOptions()), ("ordered", JobOptions(cluster=True, row_group_bytes=1 << 15))):
        result = run_job(spark, str(tmp_path / "feed"), str(tmp_path / name), options)
        assert result, result.error
        paths[name] = result.paths.analytical
    return tmp_path, paths


def test_rows_are_the_same(spark, stored):
    root, _ = stored
    bags = [sorted(map(repr, job.read_table(spark, str(root / n)).collect())) for n in ("plain", "ordered")]
    assert bags[0] == bags[1]


def test_one_group_of_a_month_reads_few_rows(spark, stored):
    root, paths = stored
    groups = row_groups(paths["ordered"])
    assert len(groups) > 20
    assert sum(s.min <= "src3" <= s.max for s in groups if s.has_min_max) < len(groups) / 10 + 1
    asked = lambda n: job.read_table(spark, str(root / n)).filter("year = 2012 and month = 1 and subreddit = 'src3'")
    month = job.read_table(spark, str(root / "ordered")).filter("year = 2012 and month = 1").count()
    assert asked("ordered").count() == asked("plain").count() > 20
    assert rows_scanned(asked("ordered")) < 0.15 * month < rows_scanned(asked("plain"))


def test_unknown_id_is_ruled_out_by_bloom_filters(spark, stored):
    root, _ = stored
    # between the least and the greatest id, so that ranges do not rule it out
    asked = job.read_table(spark, str(root / "ordered")).filter("id = 'c5000000x'").select("id")
    assert rows_scanned(asked) < 100


def test_order_holds_with_rejects_compaction_and_streams(spark, tmp_path):
    write_feed_json(one_month(spark).repartition(2), str(tmp_path / "feed"))
    options = JobOptions(cluster=True, quarantine=True, row_group_bytes=1 << 15)
    result = run_job(spark, str(tmp_path / "feed"), str(tmp_path / "out"), options)
    assert result, result.error
    run = job.compact(spark, str(tmp_path / "out"), JobOptions(cluster=True, row_group_bytes=1 << 15))
    for table in (result.paths.analytical, job.Paths(str(tmp_path / "out"), run).analytical):
        for path in glob.glob(f"{table}/year=2012/month=1/*.parquet"):
            keys = pq.read_table(path, columns=["subreddit", "created_utc_long"]).to_pylist()
            order = [(k["subreddit"] is not None, k["subreddit"] or "", k["created_utc_long"]) for k in keys]
            assert order == sorted(order)


def test_a_group_lies_in_few_pieces(spark):
    from threadsift.operators.layout import by_month

    rows = spark.range(20000).selectExpr("id", "2012 year", "1 month", "concat('g', id % 50) g")
    placed = by_month(rows, salt_columns=("id",), pieces=64, near="g", partitions=64)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = placed.select("g", F.spark_partition_id().alias("p")).distinct().groupBy("g").agg(F.count("p").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["n"] for r in spread) <= 8 < len(spread)
