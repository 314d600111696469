"""Cleaning, conversion and feature rules on hand-made edge rows."""

import datetime as dt
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from threadsift.operators import clean as c
from threadsift.operators import features as f
from threadsift.spec import FeedSpec


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def by_id(df):
    return {r["id"]: r for r in df.collect()}


BODIES = [None, "", "[deleted]", "[Deleted]", "[REMOVED]", " [deleted] ", "[deleted]x", "x"]


def test_cleaning_keeps_empty_text_and_untrimmed_placeholders(feed):
    rows = feed(*[{"body": b} for b in BODIES])
    assert ids(c.clean(rows)) == ["r1", "r5", "r6", "r7"]


def test_ingest_drops_empty_text_too(feed):
    rows = feed(*[{"body": b} for b in BODIES])
    assert ids(c.ingest_clean(rows)) == ["r5", "r6", "r7"]


def test_ingest_fills_absent_columns_with_null(feed):
    out = c.ingest_clean(feed({}, fields=("id", "body")))
    assert out.columns == list(FeedSpec().fields)
    row = out.first()
    assert row["score"] is None and row["body"] == "some text"


def test_placeholder_list_is_a_parameter(feed):
    rows = feed({"body": "GONE"}, {"body": "[deleted]"})
    assert ids(c.clean(rows, FeedSpec(placeholders=("gone",)))) == ["r1"]
    assert ids(c.clean(rows, FeedSpec(placeholders=()))) == ["r0", "r1"]


def test_placeholder_length_guard_agrees_with_plain_rule(spark):
    texts = ["[deleted]", "[DELETED]", "[İ]", "[deleted] ", "\U0001f600" * 9, "\U0001f600" * 10, "", "K", "K" * 9]
    df = spark.createDataFrame([(t,) for t in texts], "body string")
    names = ("[deleted]", "[removed]", "kkkkkkkkk")
    guarded = c.is_placeholder(F.col("body"), names)
    plain = F.lower("body").isin(*names)
    assert df.filter(~guarded.eqNullSafe(plain)).count() == 0
    assert df.filter(guarded).count() == 3


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("bad", None),
        (None, None),
        ("", None),
        (" 12 ", 12.0),
        ("1e3", 1000.0),
        ("-3.5", -3.5),
        ("Infinity", math.inf),
    ],
)
def test_score_cast(feed, text, want):
    rows = c.clean(feed({"score": text})).collect()
    assert [r["score_num"] for r in rows] == ([] if want is None else [want])


def test_nan_score_is_kept_and_positive(feed):
    row = f.analytical_table(feed({"score": "NaN"})).first()
    assert math.isnan(row["score_num"]) and row["sentiment_proxy"] == "positive"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("zz", None),
        (None, None),
        ("NaN", None),
        ("1e30", None),
        ("1e3", None),
        ("12d", None),
        ("12f", None),
        ("9223372036854775807", 2**63 - 1),
        ("9223372036854775808", None),
        ("9223372036854775808.0", None),
        (" 12.9 ", 12),
        ("-12.9", -12),
        ("1325376000", 1325376000),
        ("1325376000.0", 1325376000),
        ("1325379600.5", 1325379600),
        ("-1", -1),
        ("9007199254740993", 9007199254740993),
    ],
)
def test_time_cast_cuts_fractions(feed, text, want):
    rows = c.clean(feed({"created_utc": text})).collect()
    assert [r["created_utc_long"] for r in rows] == ([] if want is None else [want])


def test_time_without_a_date_does_not_end_the_job(feed):
    far = [str(2**63 - 1), str(-(2**63)), "99999999999999999", "9000000000001"]
    rows = f.analytical_table(feed(*[{"created_utc": t} for t in far])).collect()
    assert len(rows) == 4
    assert all(r["created_ts"] is None and r["year"] is None and r["hour"] is None for r in rows)


def test_millisecond_epoch_is_a_far_year(feed):
    # Read back as numbers: the year is beyond what a Python datetime holds.
    table = f.analytical_table(feed({"created_utc": "1325376000000"}))
    assert table.select("year", "month").first()["year"] == 43969


def test_absent_columns_have_defaults_and_drop_nothing(feed):
    table = f.analytical_table(feed({}, {"body": "[removed]"}, fields=("id", "body", "subreddit")))
    row = table.first()
    assert table.count() == 1
    assert (row["score_num"], row["is_controversial"], row["sentiment_proxy"]) == (0.0, 0, "neutral")
    assert row["created_utc_long"] is None and row["created_ts"] is None and row["year"] is None
    assert "author" not in table.columns and "subreddit_id" not in table.columns


def test_null_score_is_dropped_where_absent_score_is_zero(feed):
    assert f.analytical_table(feed({"score": None})).count() == 0
    assert f.analytical_table(feed({}, fields=("id", "body", "created_utc"))).first()["score_num"] == 0.0


@pytest.mark.parametrize(
    ("body", "length", "words"),
    [
        ("", 0, 1),
        ("hi", 2, 1),
        ("  hi there ", 11, 4),
        ("a\tb\nc", 5, 3),
        ("a \r\n b", 6, 2),
        ("a\x0bb", 3, 2),
        ("a b", 3, 1),
        ("\U0001f600é", 2, 1),
        (" ", 1, 2),
    ],
)
def test_text_features(feed, body, length, words):
    row = f.analytical_table(feed({"body": body})).first()
    assert (row["comment_length"], row["word_count"]) == (length, words)


def test_engagement_rate_of_empty_text_is_the_score(feed):
    row = f.analytical_table(feed({"body": "", "score": "-4"})).first()
    assert row["engagement_rate"] == -4.0


def test_long_text_threshold(feed):
    rows = by_id(f.analytical_table(feed({"body": "x" * 500}, {"body": "x" * 501})))
    assert [rows[i]["is_long_comment"] for i in ("r0", "r1")] == [0, 1]
    loose = f.analytical_table(feed({"body": "abc"}), FeedSpec(long_text_over=2)).first()
    assert loose["is_long_comment"] == 1


@pytest.mark.parametrize(
    ("flag", "want"),
    [(None, 0), ("0", 0), ("1", 1), ("1.0", 1), ("2", 0), ("x", 0), ("true", 1), ("false", 0)],
)
def test_flag(feed, flag, want):
    assert f.analytical_table(feed({"controversiality": flag})).first()["is_controversial"] == want


def test_sentiment_thresholds(feed):
    scores = ["-6", "-5", "5", "6", "5.5"]
    rows = by_id(f.analytical_table(feed(*[{"score": s} for s in scores])))
    got = [rows[f"r{i}"]["sentiment_proxy"] for i in range(5)]
    assert got == ["negative", "neutral", "neutral", "positive", "positive"]


def test_date_parts_are_utc_in_any_session_zone(feed, zone):
    times = ["1325376000", "1325375999", "1331449200", "1352005200", "-1"]
    rows = by_id(f.analytical_table(feed(*[{"created_utc": t} for t in times])))
    for i, t in enumerate(times):
        want = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=int(t))
        r = rows[f"r{i}"]
        assert r["created_ts"] == want
        assert (r["year"], r["month"], r["day"], r["hour"]) == (want.year, want.month, want.day, want.hour)
        assert r["day_of_week"] == want.isoweekday() % 7 + 1


def test_numeric_and_boolean_source_types(spark):
    df = spark.createDataFrame(
        [("a", "text", 7, 1325376000, "g", True), ("b", "text", 3, 1325376000, "g", None)],
        "id string, body string, score int, created_utc long, subreddit string, controversiality boolean",
    )
    rows = by_id(f.analytical_table(df))
    assert (rows["a"]["score_num"], rows["a"]["is_controversial"]) == (7.0, 1)
    assert rows["b"]["is_controversial"] == 0


def test_tags_name_the_first_broken_rule(feed):
    rows = feed(
        {"body": None, "score": "bad"},
        {"body": "[removed]"},
        {"created_utc": "zz", "score": None},
        {"score": "bad"},
        {},
    )
    tagged = c.tag(c.typed_columns(rows), c.CLEANING_RULES + c.CAST_RULES)
    got = {r["id"]: r[c.REJECT] for r in tagged.collect()}
    assert got == {"r0": c.NULL_BODY, "r1": c.PLACEHOLDER, "r2": c.BAD_TIME, "r3": c.BAD_SCORE, "r4": None}


def test_roles_are_parameters(spark):
    spec = FeedSpec(text="message", score="votes", event_time="at", group="room", flag="hot")
    df = spark.createDataFrame(
        [("1", "hello world", "9", "1325376000", "lobby", "1")],
        "id string, message string, votes string, at string, room string, hot string",
    )
    row = f.analytical_table(df, spec).first()
    assert (row["room"], row["message"], row["word_count"]) == ("lobby", "hello world", 2)
    assert (row["sentiment_proxy"], row["is_controversial"]) == ("positive", 1)


def test_text_rules_on_random_texts(spark):
    rng = random.Random(11)
    alphabet = ["a", "B", " ", "  ", "\t", "\n", "\r\n", "\x0b", "\f", "\u00a0", "\u2003", "é", "\U0001f600", "[deleted]"]
    texts = {"".join(rng.choices(alphabet, k=rng.randrange(12))) for _ in range(3000)}
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "body string")
    rows = f.text_features(df).withColumn("dropped", c.is_placeholder(F.col("body"), ("[deleted]",))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["comment_length"] == len(r["body"])
        assert r["word_count"] == len(re.split("[ \t\n\x0b\f\r]+", r["body"]))
        assert r["dropped"] == (r["body"].lower() == "[deleted]")


def test_result_does_not_depend_on_ansi_mode(spark, feed):
    def table():
        rows = feed(
            {"score": "bad"},
            {"score": "1e3", "created_utc": "1325376000.7"},
            {"created_utc": "99999999999999999"},
            {"controversiality": "x"},
            {"controversiality": "1.0", "body": ""},
        )
        return sorted(map(repr, f.analytical_table(rows).collect()))

    with_ansi = table()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert table() == with_ansi and len(with_ansi) == 4
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
