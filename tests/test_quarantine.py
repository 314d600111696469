"""Rejected rows stay, with their reason and the record as it was read."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from threadsift import JobOptions, run_job
from threadsift.operators import clean as c
from threadsift.plans import job
from threadsift.sources import commits as log
from threadsift.sources.writers import write_feed_json
from threadsift.streaming import ingest as s
from workload.feed import comment_feed

ASIDE = JobOptions(quarantine=True)


@pytest.fixture
def source(spark, tmp_path):
    path = tmp_path / "feed"
    write_feed_json(comment_feed(spark, SMALL).repartition(3), str(path))
    (path / "part-9-bad.json").write_text('{bad json\n{"id":"cut","body":"of\n')
    return str(path)


def rejects(spark, out):
    return {(r["reject"], r["record"]) for r in log.read_rejects(spark, out).collect()}


def test_kept_and_rejected_rows_are_the_rows_read(spark, source, tmp_path):
    plain, aside = (run_job(spark, source, str(tmp_path / n), o) for n, o in (("a", JobOptions()), ("b", ASIDE)))
    assert aside, aside.error
    assert aside.quality.metrics == plain.quality.metrics
    table = lambda n: sorted(map(repr, job.read_table(spark, str(tmp_path / n)).collect()))
    assert table("a") == table("b")
    found = rejects(spark, str(tmp_path / "b"))
    metrics = aside.quality.metrics
    by_reason = {k: sum(r == k for r, _ in found) for k in (*c.INGEST_RULES, *c.CAST_RULES)}
    assert by_reason == {k: metrics["extraction"].get(k, 0) + metrics["transformation"][k] for k in by_reason}
    assert len(found) + metrics["transformation"]["final_records"] == 202
    assert {x for r, x in found if r == c.CORRUPT_RECORD} == {"{bad json", '{"id":"cut","body":"of'}


def test_records_are_as_they_were_read(spark, feed, tmp_path):
    out = str(tmp_path / "out")
    rows = [{"score": "n/a", "author": "é\"x"}, {"created_utc": None}, {"body": ""}, {"body": "[deleted]", "score": None}, {}]
    write_feed_json(feed(*rows), str(tmp_path / "in"))
    assert run_job(spark, str(tmp_path / "in"), out, ASIDE)
    found = {r: json.loads(x) for r, x in rejects(spark, out)}
    assert set(found) == {c.BAD_SCORE, c.BAD_TIME, c.NULL_BODY, c.PLACEHOLDER}
    assert found[c.BAD_SCORE]["score"] == "n/a" and found[c.BAD_SCORE]["author"] == 'é"x' and found[c.BAD_SCORE]["body"] == "some text"
    assert found[c.BAD_TIME]["created_utc"] is None and found[c.PLACEHOLDER]["body"] == "[deleted]"
    months = job.read_views(spark, out)
    assert [r["comments"] for r in months["hourly_activity"].collect()] == [1]


def test_reading_rejects_leaves_kept_rows_alone(spark, source, tmp_path):
    out = str(tmp_path / "out")
    assert run_job(spark, source, out, ASIDE)
    files = [f for f in log.read_rejects(spark, out).inputFiles() if "reject=kept" not in f]
    assert files and all("month=__HIVE" in f for f in files)
    read = log.read_rejects(spark, out).select(F.input_file_name().alias("f")).distinct().collect()
    assert not any("reject=kept" in r["f"] for r in read)


def test_rejects_of_replaced_runs_are_gone_and_of_added_ones_stay(spark, feed, tmp_path):
    out = str(tmp_path / "out")
    for k, mode in enumerate(("overwrite", "append", "overwrite")):
        write_feed_json(feed({"id": f"bad{k}", "body": None}, {}), str(tmp_path / f"in{k}"))
        assert run_job(spark, str(tmp_path / f"in{k}"), out, JobOptions(quarantine=True, mode=mode))
        ids = {json.loads(x)["id"] for _, x in rejects(spark, out)}
        assert ids == ({"bad0", "bad1"} if k == 1 else {f"bad{k}"})


@pytest.mark.parametrize("options", [{"land": True}, {"limit": 5}])
def test_copies_and_limits_are_refused(spark, source, tmp_path, options):
    result = run_job(spark, source, str(tmp_path / "out"), JobOptions(quarantine=True, **options))
    assert not result and "land and limit" in str(result.error)


def test_stream_keeps_rejects(spark, source, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    s.finish(s.start_committed(s.stream_feed(spark, source, files_per_batch=2), out, checkpoint, quarantine=True))
    run_job(spark, source, str(tmp_path / "batch"), ASIDE)
    assert rejects(spark, out) == rejects(spark, str(tmp_path / "batch"))
    assert job.read_table(spark, out).count() == job.read_table(spark, str(tmp_path / "batch")).count()
