from threadsift.functions.features import (
    as_double,
    as_int,
    as_long,
    engagement_rate,
    flag_is_set,
    is_long,
    is_placeholder,
    json_double,
    sentiment_class,
    text_length,
    utc_timestamp,
    word_count,
)

__all__ = [
    "as_double",
    "as_int",
    "as_long",
    "engagement_rate",
    "flag_is_set",
    "is_long",
    "is_placeholder",
    "json_double",
    "sentiment_class",
    "text_length",
    "utc_timestamp",
    "word_count",
]
