"""What the feed looks like: column roles, fixed values and schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class FeedSpec:
    """Column roles and thresholds. The defaults are the fixed values that results depend on."""

    id: str = "id"
    text: str = "body"
    score: str = "score"
    event_time: str = "created_utc"
    group: str = "subreddit"
    group_id: str = "subreddit_id"
    author: str = "author"
    flag: str = "controversiality"

    placeholders: tuple[str, ...] = ("[deleted]", "[removed]")
    long_text_over: int = 500
    positive_over: float = 5
    negative_under: float = -5

    @property
    def fields(self) -> tuple[str, ...]:
        """The raw record, in landed order."""
        return (
            self.id,
            self.text,
            self.score,
            self.event_time,
            self.group,
            self.group_id,
            self.author,
            self.flag,
        )

    def raw_schema(self, fields: tuple[str, ...] | None = None, corrupt: bool = True) -> T.StructType:
        """Explicit read schema, all strings, so that no value can fail the scan.

        ``fields`` names the fields the feed carries. A field left out is an absent
        *column* with its own default, which is not the same as a NULL *value*.
        """
        carried = self.fields if fields is None else tuple(fields)
        unknown = [f for f in carried if f not in self.fields]
        if unknown:
            raise ValueError(f"not a field of the feed: {', '.join(unknown)}")
        names = [f for f in self.fields if f in carried]
        if corrupt:
            names.append(CORRUPT)
        return T.StructType([T.StructField(n, T.StringType()) for n in names])

    @property
    def analytical_types(self) -> dict[str, T.DataType]:
        """The analytical table: column name to type, in output order."""
        s, i, d = T.StringType(), T.IntegerType(), T.DoubleType()
        return {
            self.id: s,
            self.group: s,
            self.group_id: s,
            self.author: s,
            "created_ts": T.TimestampNTZType(),
            "created_utc_long": T.LongType(),
            "year": i,
            "month": i,
            "day": i,
            "hour": i,
            "day_of_week": i,
            "score_num": d,
            "comment_length": i,
            "word_count": i,
            "is_long_comment": i,
            "is_controversial": i,
            "engagement_rate": d,
            "sentiment_proxy": s,
            self.text: s,
        }

    def analytical_schema(self, columns: tuple[str, ...] | None = None) -> T.StructType:
        wanted = self.analytical_types
        return T.StructType(
            [T.StructField(n, t) for n, t in wanted.items() if columns is None or n in columns]
        )


DEFAULT = FeedSpec()
