"""The full job and its report."""

import glob
import json
import math

import pytest

from conftest import SMALL
from threadsift import JobOptions, run_job
from threadsift.operators import clean as c
from threadsift.operators import features as f
from threadsift.operators import views as v
from threadsift.operators.quality import QualityMetrics
from threadsift.sources.readers import read_analytical, read_feed, read_view_csv
from threadsift.sources.writers import write_feed_json
from threadsift.spec import DEFAULT
from workload.feed import comment_feed


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("job") / "feed")
    write_feed_json(comment_feed(spark, SMALL).repartition(4), path)
    with open(f"{path}/part-99999-bad.json", "w", encoding="utf-8") as out:
        out.write("{bad json\n")
    return path


def document(path):
    (part,) = glob.glob(f"{path}/part-*")
    with open(part, encoding="utf-8") as text:
        return json.load(text)


@pytest.mark.parametrize("land", [False, True])
def test_job_counters_equal_separate_counts(spark, source, tmp_path, land, zone):
    result = run_job(spark, source, str(tmp_path / "out"), JobOptions(land=land))
    assert result, result.error
    raw = read_feed(spark, source)
    feed = comment_feed(spark, SMALL)
    ingested = c.ingest_clean(raw)
    table = f.analytical_table(ingested)
    metrics = result.quality.metrics
    extraction, transformation = metrics["extraction"], metrics["transformation"]
    assert extraction["total_records"] == ingested.count()
    assert extraction["corrupt_records"] == 1
    assert extraction["null_body_records"] == feed.filter("body is null or body = ''").count()
    assert extraction["deleted_removed_records"] == feed.filter("lower(body) in ('[deleted]', '[removed]')").count()
    assert extraction["file_size_mb"] > 0
    assert transformation["initial_records"] == ingested.count()
    assert transformation["after_cleaning"] == ingested.count()
    assert transformation["cleaning_removed"] == 0
    assert transformation["final_records"] == table.count()
    dropped = transformation["bad_time_records"] + transformation["bad_score_records"]
    assert transformation["after_cleaning"] - dropped == transformation["final_records"]
    assert transformation["feature_columns"] == 19
    years = table.select("year").distinct().count()
    assert metrics["persistence"] == {
        "parquet_partitions": years,
        "parquet_months": table.select("year", "month").distinct().count(),
        "csv_files": 4,
        "visualizations": 3,
    }
    stored = read_analytical(spark, result.paths.analytical)
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, table.collect()))


def test_cleaning_counts_of_an_unfiltered_feed(spark, source, tmp_path):
    from threadsift.plans.job import transform

    quality = QualityMetrics()
    transform(read_feed(spark, source), str(tmp_path / "t"), quality=quality)
    m = quality.metrics["transformation"]
    assert m["initial_records"] == 201 and m["final_records"] == 177
    assert m["initial_records"] - m["after_cleaning"] == m["cleaning_removed"]
    assert m["corrupt_records"] == 1


def test_job_outputs(spark, source, tmp_path):
    result = run_job(spark, source, str(tmp_path / "out"))
    paths = result.paths
    table = read_analytical(spark, paths.analytical)
    for name, view in v.all_views(table).items():
        want = view.collect()
        got = read_view_csv(spark, paths.summary(name), view.schema).collect()
        assert len(got) == len(want)
        for a, b in zip(got, want, strict=True):
            assert all(x == y or math.isclose(x, y, rel_tol=1e-12) for x, y in zip(a, b, strict=True))
        shown = document(paths.dashboard(name))
        assert len(shown) == min(50, len(want))
        for a, b in zip(shown, want, strict=False):
            for key, value in b.asDict().items():
                assert a[key] == value or math.isclose(a[key], value, abs_tol=6e-11)
    shares = spark.read.parquet(paths.chart("sentiment_distribution")).collect()
    assert abs(sum(r["share_percent"] for r in shares) - 100) < 0.2
    assert spark.read.parquet(paths.chart("top20_groups")).count() == 20
    assert spark.read.parquet(paths.chart("hourly_activity")).count() == 24


@pytest.mark.parametrize("limit", [None, 60])
def test_source_may_be_a_pattern(spark, source, tmp_path, limit):
    whole = run_job(spark, source, str(tmp_path / "whole"), JobOptions(limit=limit))
    part = run_job(spark, f"{source}/part-*.json", str(tmp_path / "part"), JobOptions(limit=limit))
    assert part, part.error
    assert part.quality.metrics["extraction"] == whole.quality.metrics["extraction"]


def test_report(spark, source, tmp_path):
    result = run_job(spark, source, str(tmp_path / "out"))
    report = document(result.paths.report())
    assert list(report["metrics"]) == ["extraction", "transformation", "persistence"]
    assert report["pipeline_start"] < report["pipeline_end"]
    stored = {(r["stage"], r["metric"]): r["value"] for r in spark.read.parquet(result.paths.quality_table).collect()}
    assert stored == {(s, m): v for s, values in report["metrics"].items() for m, v in values.items()}
    assert "body:string" in report["schemas"]["raw"]
    assert "created_ts:timestamp_ntz" in report["schemas"]["analytical"]


@pytest.mark.parametrize("land", [False, True])
def test_job_with_limit(spark, source, tmp_path, land):
    result = run_job(spark, source, str(tmp_path / "out"), JobOptions(limit=60, land=land))
    assert result, result.error
    metrics = result.quality.metrics
    assert metrics["extraction"]["total_records"] == 60
    assert 0 < metrics["extraction"]["file_size_mb"] < 1
    assert metrics["transformation"]["initial_records"] == 60
    stored = read_analytical(spark, result.paths.analytical)
    assert stored.count() == metrics["transformation"]["final_records"] <= 60


@pytest.mark.parametrize("land", [False, True])
def test_empty_input_gives_empty_outputs(spark, tmp_path, land):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "empty.json").write_text("")
    result = run_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), JobOptions(land=land))
    assert result, result.error
    assert read_analytical(spark, result.paths.analytical).count() == 0
    assert document(result.paths.dashboard(v.TOP_GROUPS)) == []
    assert result.quality.metrics["transformation"]["final_records"] == 0
    assert result.quality.metrics["persistence"]["parquet_partitions"] == 0


def test_feed_without_score_time_and_flag(spark, tmp_path):
    fields = ("id", "body", "subreddit")
    write_feed_json(comment_feed(spark, SMALL).select(*fields), str(tmp_path / "in"))
    result = run_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), JobOptions(fields=fields))
    assert result, result.error
    assert result.quality.metrics["transformation"]["feature_columns"] == 17
    assert result.quality.metrics["persistence"]["parquet_partitions"] == 1


def test_failure_is_returned_with_a_report(spark, tmp_path):
    result = run_job(spark, str(tmp_path / "missing"), str(tmp_path / "out"))
    assert not result and "missing" in str(result.error)
    assert document(result.paths.report(failed=True))["metrics"] == {}


def test_failure_keeps_the_metrics_of_finished_stages(spark, source, tmp_path):
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "summaries").write_text("in the way")
    result = run_job(spark, source, str(tmp_path / "out"))
    assert not result
    report = document(result.paths.report(failed=True))
    want = c.clean(c.ingest_clean(comment_feed(spark, SMALL))).count()
    assert report["metrics"]["transformation"]["final_records"] == want
    assert "persistence" not in report["metrics"]


@pytest.mark.parametrize("missing", ["body", "subreddit"])
def test_feed_without_a_needed_column_fails_before_any_write(spark, tmp_path, missing):
    feed = comment_feed(spark, SMALL).drop(missing)
    feed.write.parquet(str(tmp_path / "in"))
    result = run_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), JobOptions(source_format="parquet"))
    assert not result and missing in str(result.error)
    assert not glob.glob(f"{result.paths.analytical}*")


@pytest.mark.parametrize("limit", [0, -5])
def test_limit_that_is_not_positive_is_refused(spark, source, tmp_path, limit):
    result = run_job(spark, source, str(tmp_path / "out"), JobOptions(limit=limit))
    assert not result and "positive" in str(result.error)


def test_collector(spark):
    quality = QualityMetrics()
    quality.add_metric("a", "x", 1)
    quality.add_metric("a", "x", 2)
    quality.add_metrics("b", {"y": 0.5})
    rows = quality.to_dataframe(spark)
    assert rows.dtypes == [("stage", "string"), ("metric", "string"), ("value", "double")]
    assert sorted(map(tuple, rows.collect())) == [("a", "x", 2.0), ("b", "y", 0.5)]


@pytest.mark.parametrize("absent", ["score", "created_utc", "subreddit", "body"])
def test_assumed_field_without_values_fails(spark, tmp_path, absent):
    fields = tuple(x for x in DEFAULT.fields if x != absent)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_feed_json(comment_feed(spark, SMALL).select(*fields), source)
    result = run_job(spark, source, out)
    assert not result and absent in str(result.error) and "no row has a value" in str(result.error)
    detected = run_job(spark, source, out, JobOptions(fields="detect"))
    if absent in ("body", "subreddit"):
        assert not detected and f"no column {absent}" in str(detected.error)
    else:
        named = run_job(spark, source, str(tmp_path / "named"), JobOptions(fields=fields))
        assert detected.quality.metrics == named.quality.metrics
        assert detected.quality.metrics["transformation"]["final_records"] > 150


def test_field_without_values_that_was_named_is_taken_at_its_word(spark, feed, tmp_path):
    write_feed_json(feed({"score": None}, {"score": None}), str(tmp_path / "in"))
    result = run_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), JobOptions(fields=DEFAULT.fields))
    assert result and result.quality.metrics["transformation"]["bad_score_records"] == 2


def test_unknown_field_is_refused(spark, feed, tmp_path):
    write_feed_json(feed({}), str(tmp_path / "in"))
    result = run_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), JobOptions(fields=("body", "created_utcc")))
    assert not result and "created_utcc" in str(result.error)
