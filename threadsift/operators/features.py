"""From typed rows to the analytical table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.functions import (
    engagement_rate,
    flag_is_set,
    is_long,
    sentiment_class,
    text_length,
    utc_timestamp,
    word_count,
)
from threadsift.operators.clean import clean
from threadsift.spec import DEFAULT, FeedSpec


def text_features(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    text = F.col(spec.text)
    return df.withColumns({"comment_length": text_length(text), "word_count": word_count(text)})


def month_columns(df: DataFrame) -> DataFrame:
    """The storage key: ``year`` and ``month`` in UTC."""
    ts = utc_timestamp(F.col("created_utc_long"))
    return df.withColumns({"year": F.year(ts), "month": F.month(ts)})


def time_features(df: DataFrame) -> DataFrame:
    ts = utc_timestamp(F.col("created_utc_long"))
    return df.withColumns(
        {
            "created_ts": ts,
            "year": F.year(ts),
            "month": F.month(ts),
            "day": F.dayofmonth(ts),
            "hour": F.hour(ts),
            "day_of_week": F.dayofweek(ts),
        }
    )


def flag_features(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """Needs ``comment_length``. Without a flag column nothing is controversial."""
    flag = flag_is_set(F.col(spec.flag)) if spec.flag in df.columns else F.lit(0)
    return df.withColumns(
        {
            "is_long_comment": is_long(F.col("comment_length"), spec.long_text_over),
            "is_controversial": flag,
        }
    )


def score_features(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """Needs ``comment_length`` and ``score_num``."""
    score = F.col("score_num")
    return df.withColumns(
        {
            "engagement_rate": engagement_rate(score, F.col("comment_length")),
            "sentiment_proxy": sentiment_class(score, spec.positive_over, spec.negative_under),
        }
    )


def all_features(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """The twelve features on typed rows."""
    return (
        df.transform(text_features, spec)
        .transform(time_features)
        .transform(flag_features, spec)
        .transform(score_features, spec)
    )


def analytical_columns(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """The analytical table's columns that exist, in order."""
    return df.select(*[c for c in spec.analytical_types if c in df.columns])


def analytical_table(raw: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """Raw feed to analytical table, no counters and no layout."""
    return raw.transform(clean, spec).transform(all_features, spec).transform(analytical_columns, spec)
