"""Sinks write what they got and read back equal; plans prune and spread as meant."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, plan_of
from threadsift.operators import features as f
from threadsift.operators import views as v
from threadsift.operators.layout import AS_READ, by_month, pieces_of_month
from threadsift.operators.table import counted_table
from threadsift.plans import job
from threadsift.sources import writers as w
from threadsift.sources.readers import (
    read_analytical,
    read_dashboard_json,
    read_feed,
    read_view_csv,
    stored_bytes,
)
from threadsift.sources.scratch import scratch_folder
from threadsift.spec import DEFAULT
from workload.feed import comment_feed


def bag(df):
    return sorted(map(repr, df.collect()))


def data_files(path):
    return sorted(p for p in glob.glob(f"{path}/**", recursive=True) if os.path.basename(p).startswith("part-"))


def write_lines(path, *lines):
    with open(path, "w", encoding="utf-8") as out:
        out.write("".join(line + "\n" for line in lines))
    return str(path)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sinks") / "table")
    job.transform(comment_feed(spark, SMALL), path)
    return path


def test_table_round_trip(spark, table):
    stored = read_analytical(spark, table)
    assert stored.columns == list(DEFAULT.analytical_types)
    assert [t for _, t in stored.dtypes] == [t.simpleString() for t in DEFAULT.analytical_types.values()]
    assert bag(stored) == bag(f.analytical_table(comment_feed(spark, SMALL)))


def test_layout_does_not_change_rows(spark, table, tmp_path):
    job.transform(comment_feed(spark, SMALL), str(tmp_path / "t"), job.JobOptions(layout=AS_READ))
    assert bag(read_analytical(spark, str(tmp_path / "t"))) == bag(read_analytical(spark, table))


def test_layout_without_adaptive_execution_salts_the_month(spark, table, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = comment_feed(spark, SMALL).withColumn("created_utc", F.lit("1325376000"))
        placed = by_month(f.analytical_table(hot), salt_columns=("id",))
        sizes = [r["n"] for r in placed.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(sizes) > 4 and max(sizes) < sum(sizes) / 2
        job.transform(comment_feed(spark, SMALL), str(tmp_path / "t"))
        assert bag(read_analytical(spark, str(tmp_path / "t"))) == bag(read_analytical(spark, table))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_unknown_layout_is_refused(spark):
    with pytest.raises(ValueError, match="layout"):
        by_month(spark.range(1).selectExpr("1 year", "1 month"), "sorted")


@pytest.mark.parametrize("partitions", ["8", "20", "2500"])
def test_hot_month_is_split_over_files(spark, tmp_path, partitions):
    values = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "50k",
        "spark.sql.shuffle.partitions": partitions,
    }
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        source = str(tmp_path / "feed")
        hot = comment_feed(spark, "/root/testdata/sf0.01").withColumn(
            "created_utc", F.when(F.crc32("id") % 3 > 0, "1325376000").otherwise(F.col("created_utc"))
        )
        w.write_feed_json(hot.repartition(8), source)
        job.transform(read_feed(spark, source), str(tmp_path / "t"))
        assert len(data_files(tmp_path / "t" / "year=2012" / "month=1")) > 2
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_asked_partitions_are_kept(spark):
    rows = spark.range(1).selectExpr("1 year", "1 month")
    assert ", 20)" in plan_of(by_month(rows, partitions=20), "simple")
    assert ", 9000)" in plan_of(by_month(rows, partitions=9000), "simple")


def test_pieces_grow_with_the_feed(spark):
    assert pieces_of_month(spark, None) == pieces_of_month(spark, 1) == 8
    assert pieces_of_month(spark, 100 << 40) == (100 << 40) // (32 * (64 << 20))


def test_empty_run_replaces_all_views(spark, feed, tmp_path):
    source, out = str(tmp_path / "feed"), str(tmp_path / "out")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        w.write_feed_json(feed({}, {}), source)
        assert job.run_job(spark, source, out)
        w.write_feed_json(feed({"body": "[deleted]"}), source)
        result = job.run_job(spark, source, out)
        assert result and result.quality.metrics["transformation"]["final_records"] == 0
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert not data_files(tmp_path / "out" / "view_summary")
    assert spark.read.csv(f"{out}/summaries/top_subreddits", header=True, schema="a string").count() == 0


def test_size_is_that_of_the_files_read(spark, feed, tmp_path):
    source = tmp_path / "feed"
    w.write_feed_json(feed({}, {}).coalesce(1), str(source))
    (source / "nested").mkdir()
    (source / "nested" / "part-9.json").write_text("x" * 5_000_000)
    read = sum(f.stat().st_size for f in source.glob("*.json"))
    assert stored_bytes(spark, str(source)) == read
    assert job.run_job(spark, str(source), str(tmp_path / "out")).quality.metrics["extraction"]["file_size_mb"] == round(read / 1024**2, 2)


def test_month_filter_prunes_directories(spark, table):
    plan = plan_of(read_analytical(spark, table).filter("year = 1997 and month = 2").select("id"))
    line = next(x for x in plan.splitlines() if x.startswith("PartitionFilters"))
    assert "year" in line and "month" in line
    assert "body" not in next(x for x in plan.splitlines() if x.startswith("ReadSchema"))


def test_counters_sit_above_the_shuffle(spark, tmp_path):
    w.write_feed_json(comment_feed(spark, SMALL), str(tmp_path / "feed"))
    plan = plan_of(counted_table(read_feed(spark, str(tmp_path / "feed")), "c"), "simple")
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert plan.index("CollectMetrics") < plan.index("Exchange") < plan.index("FileScan")
    # the costly text features come after the filter, the shuffle carries none of them
    assert plan.index("split(") < plan.index("CollectMetrics")
    assert "split(" not in plan[plan.index("Exchange"):]


def test_null_month_goes_to_its_own_folder(spark, feed, tmp_path):
    path = str(tmp_path / "t")
    job.transform(feed({"created_utc": str(2**62)}, {}), path)
    stored = read_analytical(spark, path)
    assert sorted((r["year"] or 0, r["month"] or 0) for r in stored.collect()) == [(0, 0), (2012, 1)]
    assert job.month_metrics(stored) == {"parquet_partitions": 2, "parquet_months": 2}


def test_overwrite_modes(spark, feed, tmp_path):
    path = str(tmp_path / "t")
    january, february = feed({}, {}), feed({"created_utc": "1328054400"})

    def months(mode, rows):
        job.transform(rows, path, job.JobOptions(mode=mode))
        return {(r["month"], r["records"]) for r in job.stored_months(read_analytical(spark, path)).collect()}

    assert months("overwrite", january) == {(1, 2)}
    assert months("append", february) == {(1, 2), (2, 1)}
    assert months(w.OVERWRITE_MONTHS, feed({})) == {(1, 1), (2, 1)}
    assert months("overwrite", february) == {(2, 1)}


def test_feed_json_round_trip_keeps_null_keys(spark, tmp_path):
    feed = comment_feed(spark, SMALL)
    w.write_feed_json(feed, str(tmp_path / "feed"))
    back = read_feed(spark, str(tmp_path / "feed")).drop("_corrupt_record")
    assert bag(back) == bag(feed)
    with open(data_files(tmp_path / "feed")[0], encoding="utf-8") as lines:
        assert all(list(json.loads(line)) == list(DEFAULT.fields) for line in lines)


def test_bad_lines_are_rows_with_the_line_kept(spark, tmp_path):
    path = write_lines(tmp_path / "f.json", '{"id":"a","body":"x"}', "{bad json", "", '{"id":"b","body":"cut')
    rows = read_feed(spark, path).collect()
    assert [(r["id"], r["_corrupt_record"]) for r in rows] == [
        ("a", None),
        (None, "{bad json"),
        (None, '{"id":"b","body":"cut'),
    ]


def test_numbers_keep_their_text(spark, tmp_path):
    path = write_lines(tmp_path / "f.json", '{"id":1,"body":"x","score":1e3,"created_utc":1325376000.0}')
    row = read_feed(spark, path).first()
    assert (row["score"], row["created_utc"]) == ("1e3", "1325376000.0")
    assert f.analytical_table(read_feed(spark, path)).first()["created_utc_long"] == 1325376000


def test_parquet_feed(spark, tmp_path):
    feed = comment_feed(spark, SMALL)
    feed.write.parquet(str(tmp_path / "p"))
    got = f.analytical_table(read_feed(spark, str(tmp_path / "p"), "parquet"))
    assert bag(got) == bag(f.analytical_table(feed))
    with pytest.raises(ValueError, match="format"):
        read_feed(spark, "x", "xml")


def test_csv_keeps_null_empty_and_odd_keys_apart(spark, tmp_path):
    keys = [None, "", "a,b", 'q"x', " padded ", "NULL", "é\U0001f600"]
    view = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "subreddit string, total_comments long")
    w.write_view_csv(view.orderBy("total_comments"), str(tmp_path / "csv"))
    assert [r["subreddit"] for r in read_view_csv(spark, str(tmp_path / "csv"), view.schema).collect()] == keys


def test_csv_header_precision_and_order(spark, table, tmp_path):
    view = v.hourly_activity(read_analytical(spark, table))
    w.write_view_csv(view, str(tmp_path / "csv"), files=1)
    (path,) = data_files(tmp_path / "csv")
    with open(path, encoding="utf-8") as lines:
        header, *rows = lines.read().splitlines()
    assert header == "hour,comments,avg_score"
    assert [tuple(map(float, r.split(","))) for r in rows] == [tuple(r) for r in view.collect()]


def test_large_view_keeps_its_order_over_several_files(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(5000).selectExpr("concat('g', id) subreddit", "pmod(hash(id), 50) total_comments")
        view = rows.orderBy(*v.view_order(v.TOP_GROUPS))
        w.write_view_csv(view, str(tmp_path / "csv"))
        files = data_files(tmp_path / "csv")
        assert len(files) > 1
        lines = [line for p in files for line in open(p, encoding="utf-8").read().splitlines()[1:]]
        assert lines == [f"{r[0]},{r[1]}" for r in view.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_dashboard_is_an_ordered_indented_array(spark, tmp_path):
    rows = [(None, float("nan")), ("a", 1 / 3), ("b", 2.0), ("c", float("inf")), ("d", None)]
    view = spark.createDataFrame(rows, "subreddit string, avg_engagement double").repartition(4)
    order = [F.asc_nulls_last("subreddit")]
    w.write_dashboard_json(view, order, str(tmp_path / "d.json"))
    (path,) = data_files(tmp_path / "d.json")
    with open(path, encoding="utf-8") as text:
        document = text.read()
    assert document.count("\n") > 5
    assert json.loads(document) == [
        {"subreddit": "a", "avg_engagement": 0.3333333333},
        {"subreddit": "b", "avg_engagement": 2.0},
        {"subreddit": "c", "avg_engagement": None},
        {"subreddit": "d", "avg_engagement": None},
        {"subreddit": None, "avg_engagement": None},
    ]
    assert read_dashboard_json(spark, str(tmp_path / "d.json"), view.schema).count() == 5


def test_dashboard_holds_the_first_rows_only(spark, tmp_path):
    view = spark.range(5000).selectExpr("concat('g', id) subreddit", "pmod(hash(id), 70) total_comments")
    order = v.view_order(v.TOP_GROUPS)
    w.write_dashboard_json(view, order, str(tmp_path / "d.json"))
    (path,) = data_files(tmp_path / "d.json")
    shown = json.load(open(path, encoding="utf-8"))
    assert shown == [r.asDict() for r in view.orderBy(*order).limit(50).collect()]


def test_dashboard_of_nothing_is_an_empty_array(spark, tmp_path):
    view = spark.createDataFrame([], "subreddit string, total_comments long")
    order = [F.asc("subreddit")]
    w.write_dashboard_json(view, order, str(tmp_path / "d.json"))
    (path,) = data_files(tmp_path / "d.json")
    assert json.load(open(path, encoding="utf-8")) == []


def test_stored_bytes_are_the_bytes_on_disk(spark, table):
    assert stored_bytes(spark, table) == sum(os.path.getsize(p) for p in data_files(table))


def test_scratch_uses_the_shared_folder_and_refuses_a_local_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first != second and first.startswith(f"{shared}/x-")
