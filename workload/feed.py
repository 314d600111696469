"""A comment feed derived from the given tables.

Every document that has an event and an order of its number is a comment, with its whole text:
documents give text, group and language, events the time of day, user and score, orders the
day, labels the flag. Every rule of the cleaning stage gets rows that break it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift.spec import DEFAULT

SECONDS_PER_DAY = 86400

# Only the columns the feed needs. With the schema given, no file is opened to plan a query.
TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, value double",
    "orders": "o_orderkey bigint, o_orderdate timestamp_ntz",
    "labels": "doc_id bigint, toxic int",
}

# Rows whose number is divisible get the value, first match first.
DIRTY_BODY = {37: None, 41: "[deleted]", 43: "[Removed]", 47: ""}
DIRTY_SCORE = {53: "n/a", 61: None}
DIRTY_TIME = {59: "bad"}
DIRTY_GROUP = {67: None}


def _epoch_seconds(ts: Column) -> Column:
    # The tables' timestamps have no zone; this does not depend on the session's zone.
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def _dirty(number: Column, dirt: dict, clean: Column) -> Column:
    out = None
    for divisor, value in dirt.items():
        hit = number % divisor == 0
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return clean if out is None else out.otherwise(clean)


def comment_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw feed: eight fields, all as text."""
    documents, events, orders, labels = (
        spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet") for name, schema in TABLES.items()
    )
    events = events.withColumnRenamed("event_id", "doc_id")
    orders = orders.withColumnRenamed("o_orderkey", "doc_id")
    joined = documents.join(events, "doc_id").join(orders, "doc_id").join(labels, "doc_id", "left")

    n = F.col("doc_id")
    time = _epoch_seconds(F.col("o_orderdate")) + F.pmod(_epoch_seconds(F.col("ts")), F.lit(SECONDS_PER_DAY))
    score = F.floor("value") % 41 - 15
    values = {
        DEFAULT.id: F.concat(F.lit("c"), n.cast("string")),
        DEFAULT.text: _dirty(n, DIRTY_BODY, F.col("text")),
        DEFAULT.score: _dirty(n, DIRTY_SCORE, score.cast("string")),
        DEFAULT.event_time: _dirty(n, DIRTY_TIME, time.cast("string")),
        DEFAULT.group: _dirty(n, DIRTY_GROUP, F.col("source")),
        DEFAULT.group_id: F.col("lang"),
        DEFAULT.author: F.concat(F.lit("u"), F.col("user_id").cast("string")),
        DEFAULT.flag: F.col("toxic").cast("string"),
    }
    return joined.select(*[c.alias(name) for name, c in values.items()])
