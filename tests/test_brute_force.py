"""The whole job on a random dirty feed, against a plain Python reading of the rules."""

import collections
import datetime as dt
import json
import math
import random
import re

import pytest

from threadsift import JobOptions, run_job
from threadsift.operators import views as v
from threadsift.sources.readers import read_analytical

# what stands in the file, and the number it means (None: does not convert)
SCORES = [
    (5, 5.0), (6, 6.0), (-5, -5.0), (-6, -6.0), (0, 0.0), (2.5, 2.5), (1e3, 1000.0), ("7", 7.0), (" 12 ", 12.0),
    ("-3e0", -3.0), ("n/a", None), ("", None), (None, None), ("1,5", None), ("0x1F", None),
]
TIMES = [
    (1325376000, 1325376000), (1325375999, 1325375999), ("1331449200", 1331449200), (1352005200.0, 1352005200),
    ("1325379600.9", 1325379600), (-1, -1), (951782400, 951782400), ("soon", None), (None, None), ("", None),
]
BODIES = [
    "plain words here", "  two  gaps ", "tab\tand\nline", "[deleted]", "[REMOVED]", " [removed]", "", None,
    "x" * 500, "y" * 501, "é\U0001f600 ok", '"quoted", \\ and {braces}', "[deleted] not",
]
FLAGS = [(0, 0), (1, 1), ("1", 1), ("0", 0), (None, 0), (True, 1), (False, 0), ("x", 0), (1.0, 1), (2, 0)]
GROUPS = ["hot"] * 6 + ["a", "b", "", "é", None]


def random_feed(rng, rows):
    """Lines of the feed and, for each kept row, what the table must hold."""
    lines, want, counts = [], {}, collections.Counter()
    for n in range(rows):
        counts["rows"] += 1
        if rng.random() < 0.01:
            lines.append('{"id": "cut", "body": "no end')
            counts["corrupt_records"] += 1
            continue
        body, group = rng.choice(BODIES), rng.choice(GROUPS)
        (score, score_num), (time, seconds), (flag, is_set) = rng.choice(SCORES), rng.choice(TIMES), rng.choice(FLAGS)
        record = {"id": f"r{n}", "body": body, "score": score, "created_utc": time, "subreddit": group}
        record |= {"subreddit_id": f"t{n % 3}", "author": f"u{n % 7}", "controversiality": flag, "extra": {"a": [1]}}
        for name in ("author", "controversiality"):
            if rng.random() < 0.1:
                del record[name]
        lines.append(json.dumps(record, ensure_ascii=rng.random() < 0.5))
        if not body:
            counts["null_body_records"] += 1
        elif body.lower() in ("[deleted]", "[removed]"):
            counts["deleted_removed_records"] += 1
        elif seconds is None:
            counts["bad_time_records"] += 1
        elif score_num is None:
            counts["bad_score_records"] += 1
        else:
            ts = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=seconds)
            want[f"r{n}"] = (
                group, f"t{n % 3}", record.get("author"), ts, seconds, ts.year, ts.month, ts.day, ts.hour,
                ts.isoweekday() % 7 + 1, score_num, len(body), len(re.split("[ \t\n\x0b\f\r]+", body)),
                int(len(body) > 500), is_set if "controversiality" in record else 0, score_num / (len(body) + 1),
                "positive" if score_num > 5 else "negative" if score_num < -5 else "neutral", body,
            )
    return lines, want, counts


@pytest.mark.parametrize("options", [JobOptions(), JobOptions(land=True), JobOptions(layout="as_read")])
def test_job_on_a_random_feed(spark, tmp_path, zone, options):
    rng = random.Random(repr(options) + zone)
    lines, want, counts = random_feed(rng, 4000)
    (tmp_path / "in").mkdir()
    for part in range(5):
        (tmp_path / "in" / f"{part}.json").write_text("\n".join(lines[part::5]) + "\n", encoding="utf-8")
    result = run_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), options)
    assert result, result.error

    table = read_analytical(spark, result.paths.analytical)
    assert {r[0]: tuple(r[1:]) for r in table.collect()} == want

    metrics = result.quality.metrics
    ingest_drops = ("corrupt_records", "null_body_records", "deleted_removed_records")
    assert {k: metrics["extraction"][k] for k in ingest_drops} == {k: counts[k] for k in ingest_drops}
    assert metrics["transformation"]["initial_records"] == counts["rows"] - sum(counts[k] for k in ingest_drops)
    for name in ("bad_time_records", "bad_score_records"):
        assert metrics["transformation"][name] == counts[name]
    assert metrics["transformation"]["final_records"] == len(want)

    groups = collections.defaultdict(list)
    for row in want.values():
        groups[row[0]].append(row)
    views = v.views_of_summary(spark.read.parquet(result.paths.view_summary))
    top = views[v.TOP_GROUPS].collect()
    assert [r["subreddit"] for r in top] == sorted(groups, key=lambda g: (-len(groups[g]), g is None, g or ""))
    for r in top:
        mine = groups[r["subreddit"]]
        assert r["total_comments"] == len(mine)
        assert math.isclose(r["total_score"], sum(x[10] for x in mine))
        assert math.isclose(r["avg_comment_length"], sum(x[11] for x in mine) / len(mine))
    hours = {r["hour"]: r["comments"] for r in views[v.HOURLY].collect()}
    assert hours == collections.Counter(x[8] for x in want.values())
    classes = {r["sentiment_proxy"]: r["count"] for r in views[v.SENTIMENT].collect()}
    assert classes == collections.Counter(x[16] for x in want.values())
