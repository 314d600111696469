"""Bounded results as one file of the stated name."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from threadsift import JobOptions, run_job
from threadsift.operators import views as v
from threadsift.plans import job
from threadsift.sources import single_file
from threadsift.sources.readers import read_dashboard_json
from threadsift.sources.single_file import write_single_file
from threadsift.sources.writers import write_feed_json
from workload.feed import comment_feed

FILES = JobOptions(single_files=True)


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)


def test_job_writes_files_of_the_stated_names(spark, tmp_path):
    write_feed_json(comment_feed(spark, SMALL), str(tmp_path / "in"))
    result = run_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), FILES)
    assert result, result.error
    plain = run_job(spark, str(tmp_path / "in"), str(tmp_path / "plain"))
    for name, view in job.read_views(spark, str(tmp_path / "out")).items():
        path = result.paths.dashboard(name)
        assert os.path.isfile(path) and os.path.basename(path) == f"{name}.json"
        text = open(path, encoding="utf-8").read()
        assert text.startswith("[") and text.count("\n") > 5
        want = read_dashboard_json(spark, plain.paths.dashboard(name), view.schema).collect()
        assert read_dashboard_json(spark, path, view.schema).collect() == want
    report = json.load(open(result.paths.report(), encoding="utf-8"))
    assert report["metrics"] == result.quality.metrics
    assert sorted(n for n in os.listdir(tmp_path / "out" / "dashboard_data") if not n.startswith(".")) == sorted(f"{n}.json" for n in v.VIEWS)


def test_failed_run_leaves_no_new_file(spark, tmp_path):
    write_feed_json(comment_feed(spark, SMALL), str(tmp_path / "in"))
    write_feed_json(comment_feed(spark, SMALL).drop("score"), str(tmp_path / "bad"))
    result = run_job(spark, str(tmp_path / "bad"), str(tmp_path / "out"), FILES)
    assert not result and not os.path.exists(result.paths.dashboard(v.TOP_GROUPS))
    assert os.path.isfile(result.paths.report(failed=True))
    good = run_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), FILES)
    before = open(good.paths.dashboard(v.TOP_GROUPS), encoding="utf-8").read()
    assert not run_job(spark, str(tmp_path / "bad"), str(tmp_path / "out"), FILES)
    assert open(good.paths.dashboard(v.TOP_GROUPS), encoding="utf-8").read() == before


def test_write_replaces_a_file_or_a_folder(spark, tmp_path):
    path = str(tmp_path / "deep" / "f.json")
    for text in ("one\né", "two"):
        write_single_file(spark, lines(spark, text), path)
        assert open(path, encoding="utf-8").read() == f"{text}\n"
    lines(spark, "x").write.text(str(tmp_path / "folder"))
    write_single_file(spark, lines(spark, "y"), f"file://{tmp_path}/folder")
    assert open(tmp_path / "folder", encoding="utf-8").read() == "y\n"
    write_single_file(spark, lines(spark), path)
    assert os.path.getsize(path) == 0


def test_failed_write_keeps_what_was_there(spark, tmp_path):
    path = str(tmp_path / "f")
    write_single_file(spark, lines(spark, "good"), path)
    with pytest.raises(Exception, match="no way"):
        write_single_file(spark, lines(spark, "x").select(F.raise_error(F.concat(F.lit("no way"), "value")).cast("string").alias("value")), path)
    assert open(path, encoding="utf-8").read() == "good\n" and os.listdir(tmp_path) == ["f"]


def test_only_bounded_text_is_taken(spark, tmp_path, monkeypatch):
    with pytest.raises(Exception, match="one text column"):
        write_single_file(spark, spark.range(3), str(tmp_path / "f"))
    monkeypatch.setattr(single_file, "MOST_BYTES", 10)
    with pytest.raises(Exception, match="more than 10"):
        write_single_file(spark, lines(spark, "x" * 11), str(tmp_path / "f"))
    assert os.listdir(tmp_path) == []
