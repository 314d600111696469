"""Scalar column expressions. All are JVM built-ins; none can fail on a bad value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# TIMESTAMP_NTZ holds +-9.22e18 microseconds. Seconds outside this range have no
# calendar date, and timestamp_add would raise on them and end the job.
_MAX_EPOCH_SECONDS = 9_000_000_000_000


def _truncated(c: Column, to: str) -> Column:
    # A direct try_cast refuses '1325379600.0', the text of a float in the feed. Its whole part is
    # taken as text, so all 64 bits stay and what is out of range is NULL. Other notations of
    # numbers ('1e3', '12d') are not whole numbers here, as in the plain cast.
    whole = F.regexp_extract(c.cast("string"), r"^\s*([+-]?\d+)\.\d*\s*$", 1)
    return F.coalesce(c.try_cast(to), whole.try_cast(to))


def as_long(c: Column) -> Column:
    """Whole number, fraction cut off; NULL when it does not convert."""
    return _truncated(c, "bigint")


def as_int(c: Column) -> Column:
    return _truncated(c, "int")


def as_double(c: Column) -> Column:
    """Double, or NULL when it does not convert. The text ``NaN`` is a value."""
    return c.try_cast("double")


def is_placeholder(text: Column, placeholders: Sequence[str]) -> Column:
    """Text equal to a placeholder in any letter case, spaces not trimmed.

    The byte length is known without reading the text, so it goes first: long texts are
    never lower-cased. Lower-casing does not shorten a text and a character takes
    at most four bytes, hence the bound.
    """
    if not placeholders:
        return F.when(text.isNotNull(), F.lit(False))
    longest = 4 * max(len(p) for p in placeholders)
    return (F.octet_length(text) <= longest) & F.lower(text).isin(*[p.lower() for p in placeholders])


def text_length(text: Column) -> Column:
    """Length in characters (code points)."""
    return F.length(text)


def word_count(text: Column) -> Column:
    r"""Pieces of the text between runs of ``\s``: at least 1, and one more for each
    leading or trailing run."""
    return F.size(F.split(text, r"\s+"))


def utc_timestamp(epoch_seconds: Column) -> Column:
    """UTC wall clock as TIMESTAMP_NTZ, whatever time zone the session has."""
    in_range = epoch_seconds.between(-_MAX_EPOCH_SECONDS, _MAX_EPOCH_SECONDS)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.when(in_range, F.timestamp_add("SECOND", epoch_seconds, epoch))


def is_long(length: Column, over: int) -> Column:
    return F.when(length > over, 1).otherwise(0)


def flag_is_set(flag: Column) -> Column:
    """1 when the flag's whole part is 1 or it is a JSON ``true``, else 0; NULL and other text give 0.

    JSON fields are read as text, where ``true`` and ``"true"`` look alike: both count as set.
    """
    return F.when((as_int(flag) == 1) | (flag.cast("string") == "true"), 1).otherwise(0)


def engagement_rate(score: Column, length: Column) -> Column:
    """Score per character; the divisor is at least 1."""
    return score / (length + F.lit(1))


def sentiment_class(score: Column, positive_over: float, negative_under: float) -> Column:
    """Class by score; both thresholds belong to ``neutral``."""
    return (
        F.when(score > positive_over, "positive")
        .when(score < negative_under, "negative")
        .otherwise("neutral")
    )


def json_double(c: Column, digits: int = 10) -> Column:
    """A double as the dashboard files show it: rounded, NULL when not finite."""
    finite = ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    return F.when(finite, F.round(c, digits))
