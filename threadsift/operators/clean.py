"""Cleaning: tolerant projection, row rules, type conversion.

A rule is a name with a Boolean expression that is true for a row to drop. ``tag`` writes
the name of the first broken rule into one column, so that one pass can both count the
drops per reason and filter them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.functions import as_double, as_long, is_placeholder
from threadsift.spec import CORRUPT, DEFAULT, FeedSpec

REJECT = "_reject"

CORRUPT_RECORD = "corrupt_records"
NULL_BODY = "null_body_records"
PLACEHOLDER = "deleted_removed_records"
BAD_TIME = "bad_time_records"
BAD_SCORE = "bad_score_records"

INGEST_RULES = (CORRUPT_RECORD, NULL_BODY, PLACEHOLDER)
CLEANING_RULES = (CORRUPT_RECORD, NULL_BODY, PLACEHOLDER)
CAST_RULES = (BAD_TIME, BAD_SCORE)


def feed_columns(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """The feed's columns that exist, in landed order; everything else goes."""
    return df.select(*[c for c in spec.fields if c in df.columns])


def all_feed_columns(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """All eight feed columns; an absent one is NULL."""
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in spec.fields]
    )


def drop_null_text(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """Cleaning keeps the empty text."""
    return df.filter(F.col(spec.text).isNotNull())


def drop_empty_text(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """Ingest drops NULL and the empty text."""
    return df.filter(F.col(spec.text).isNotNull() & (F.col(spec.text) != ""))


def drop_placeholders(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    return df.filter(~is_placeholder(F.col(spec.text), spec.placeholders))


def typed_columns(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """Adds ``created_utc_long`` and ``score_num``, with the defaults of absent columns."""
    time = as_long(F.col(spec.event_time)) if spec.event_time in df.columns else F.lit(None).cast("bigint")
    score = as_double(F.col(spec.score)) if spec.score in df.columns else F.lit(0.0)
    return df.withColumns({"created_utc_long": time, "score_num": score})


def drop_unconverted(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """Drops typed rows whose value did not convert. An absent column drops nothing."""
    for raw, typed in ((spec.event_time, "created_utc_long"), (spec.score, "score_num")):
        if raw in df.columns:
            df = df.filter(F.col(typed).isNotNull())
    return df


def clean(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """All row rules and conversions of the transform stage as plain filters."""
    return (
        feed_columns(df, spec)
        .transform(drop_null_text, spec)
        .transform(drop_placeholders, spec)
        .transform(typed_columns, spec)
        .transform(drop_unconverted, spec)
    )


def ingest_clean(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """All row rules of the ingest stage as plain filters, with the eight feed columns."""
    return (
        df.transform(drop_empty_text, spec)
        .transform(drop_placeholders, spec)
        .transform(all_feed_columns, spec)
    )


def _broken(df: DataFrame, rule: str, spec: FeedSpec, drop_empty: bool) -> Column | None:
    text = F.col(spec.text)
    if rule == CORRUPT_RECORD:
        return F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else None
    if rule == NULL_BODY:
        return (text.isNull() | (text == "")) if drop_empty else text.isNull()
    if rule == PLACEHOLDER:
        return is_placeholder(text, spec.placeholders)
    if rule == BAD_TIME:
        return F.col("created_utc_long").isNull() if spec.event_time in df.columns else None
    if rule == BAD_SCORE:
        return F.col("score_num").isNull() if spec.score in df.columns else None
    raise ValueError(f"unknown rule {rule!r}")


def tag(
    df: DataFrame, rules: tuple[str, ...], spec: FeedSpec = DEFAULT, drop_empty: bool = False
) -> DataFrame:
    """Adds ``_reject``: the first broken rule of each row, NULL for a row to keep.

    The cast rules need ``typed_columns`` first.
    """
    reason = None
    for rule in rules:
        broken = _broken(df, rule, spec, drop_empty)
        if broken is not None:
            reason = F.when(broken, rule) if reason is None else reason.when(broken, rule)
    return df.withColumn(REJECT, F.lit(None).cast("string") if reason is None else reason)


def keep_tagged(df: DataFrame) -> DataFrame:
    """Rows without a reject reason; the helper columns go."""
    return df.filter(F.col(REJECT).isNull()).drop(REJECT, CORRUPT)
