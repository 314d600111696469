"""Grouped views, top-k and chart tables over the analytical table.

Each aggregate combines map-side before its shuffle, so a group with a third of all rows
costs one partial row per task. Every order ends with the group key, NULL last, which
makes a top-k the same on each run even among ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadsift.spec import DEFAULT, FeedSpec

TOP_GROUPS = "top_subreddits"
HOURLY = "hourly_activity"
SENTIMENT = "sentiment_distribution"
ENGAGEMENT = "engagement"

VIEWS = (TOP_GROUPS, HOURLY, SENTIMENT, ENGAGEMENT)
# Views with one row per group grow with the number of groups; the others are bounded
# by 25 hours (one of them NULL) and 3 classes.
BOUNDED_VIEWS = (HOURLY, SENTIMENT)

DASHBOARD_ROWS = 50
_ORDER_DIGITS = 12
CHART_ROWS = 20


def _measures() -> dict[str, Column]:
    return {
        "row_count": F.count(F.lit(1)),
        "avg_score": F.avg("score_num"),
        "avg_comment_length": F.avg("comment_length"),
        "total_score": F.sum("score_num"),
        "avg_engagement": F.avg("engagement_rate"),
        "controversial_count": F.sum("is_controversial"),
        "avg_words": F.avg("word_count"),
    }


def _columns(view: str, spec: FeedSpec) -> list[tuple[str, str]]:
    """Output name and measure (or key) of each column of a view."""
    return {
        TOP_GROUPS: [
            (spec.group, spec.group),
            ("total_comments", "row_count"),
            ("avg_score", "avg_score"),
            ("avg_comment_length", "avg_comment_length"),
            ("total_score", "total_score"),
            ("avg_engagement", "avg_engagement"),
        ],
        HOURLY: [("hour", "hour"), ("comments", "row_count"), ("avg_score", "avg_score")],
        SENTIMENT: [("sentiment_proxy", "sentiment_proxy"), ("count", "row_count")],
        ENGAGEMENT: [
            (spec.group, spec.group),
            ("avg_engagement", "avg_engagement"),
            ("controversial_count", "controversial_count"),
            ("avg_words", "avg_words"),
        ],
    }[view]


def _key(view: str, spec: FeedSpec) -> str:
    return _columns(view, spec)[0][0]


def view_order(view: str, spec: FeedSpec = DEFAULT) -> list[Column]:
    key = F.asc_nulls_last(_key(view, spec))
    if view == TOP_GROUPS:
        return [F.desc("total_comments"), key]
    if view == ENGAGEMENT:
        # The last bits of an average follow the order of addition, which differs from run to
        # run; rounded, equal averages are ties in each of them.
        return [F.round("avg_engagement", _ORDER_DIGITS).desc(), key]
    if view == SENTIMENT:
        return [F.desc("count"), key]
    return [F.asc_nulls_first(_key(view, spec))]


def _view(df: DataFrame, view: str, spec: FeedSpec) -> DataFrame:
    (key, _), *rest = _columns(view, spec)
    measures = _measures()
    return (
        df.groupBy(key)
        .agg(*[measures[m].alias(name) for name, m in rest])
        .orderBy(*view_order(view, spec))
    )


def top_groups(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    return _view(df, TOP_GROUPS, spec)


def hourly_activity(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    return _view(df, HOURLY, spec)


def sentiment_distribution(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    return _view(df, SENTIMENT, spec)


def engagement(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    return _view(df, ENGAGEMENT, spec)


def all_views(df: DataFrame, spec: FeedSpec = DEFAULT) -> dict[str, DataFrame]:
    """The four views, each from its own scan of the table's few columns it needs."""
    return {v: _view(df, v, spec) for v in VIEWS}


# --- all views from one scan ------------------------------------------------------------

GROUPED_BY = "grouped_by"


def view_summary(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """All measures by group, by hour and by class, from one scan and one shuffle.

    One row per key of each of the three grouping sets; ``grouped_by`` names the set. Write it
    once, then take every view from it with ``views_of_summary``.
    """
    keys = [spec.group, "hour", "sentiment_proxy"]
    # grouping_id has one bit per key, leftmost key highest, set when the key is rolled up.
    ids = {0b011: spec.group, 0b101: "hour", 0b110: "sentiment_proxy"}
    name = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])
    grouped = df.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(
        F.grouping_id().cast("int").alias("_set"), *[m.alias(n) for n, m in _measures().items()]
    )
    return grouped.select(name[F.col("_set")].alias(GROUPED_BY), *keys, *_measures())


# --- sums by month that add up over runs ------------------------------------------------

_AVERAGED = {"avg_score": "score_num", "avg_comment_length": "comment_length", "avg_engagement": "engagement_rate", "avg_words": "word_count"}


def month_state(df: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """Counts and sums by month and group, hour or class, from one scan and one shuffle.

    They add up: the states of the months of a table, from whichever runs, make its views
    (``summary_of_state``), so a run that changes some months reads only those.
    """
    keys = [spec.group, "hour", "sentiment_proxy"]
    ids = {0b011: spec.group, 0b101: "hour", 0b110: "sentiment_proxy"}
    name = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])
    sums = {"row_count": F.count(F.lit(1)), "total_score": F.sum("score_num"), "controversial_count": F.sum("is_controversial")}
    for average, column in _AVERAGED.items():
        sums |= {f"sum_{average}": F.sum(F.col(column).cast("double")), f"n_{average}": F.count(column)}
    columns = ["year", "month", *keys]
    grouped = df.groupingSets([[F.col("year"), F.col("month"), F.col(k)] for k in keys], *[F.col(c) for c in columns]).agg(
        F.grouping_id().cast("int").alias("_set"), *[c.alias(n) for n, c in sums.items()]
    )
    return grouped.select(name[F.col("_set")].alias(GROUPED_BY), *columns, *sums)


def state_schema(spec: FeedSpec = DEFAULT) -> T.StructType:
    s, i, n, d = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
    kinds = {GROUPED_BY: s, "year": i, "month": i, spec.group: s, "hour": i, "sentiment_proxy": s}
    kinds |= {"row_count": n, "total_score": d, "controversial_count": n}
    for average in _AVERAGED:
        kinds |= {f"sum_{average}": d, f"n_{average}": n}
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def added_states(state: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """States of several runs as one with the same months."""
    kinds = state_schema(spec)
    keys = [GROUPED_BY, "year", "month", spec.group, "hour", "sentiment_proxy"]
    return state.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in kinds.names if c not in keys])


def summary_of_state(state: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """The same rows as ``view_summary`` of the table that the state was taken from."""
    keys = [spec.group, "hour", "sentiment_proxy"]
    added = {n: F.sum(n) for n in ("row_count", "total_score", "controversial_count")}
    added |= {n: F.try_divide(F.sum(f"sum_{n}"), F.sum(f"n_{n}")) for n in _AVERAGED}
    return state.groupBy(GROUPED_BY, *keys).agg(*[added[n].alias(n) for n in _measures()])


def months_of_state(state: DataFrame) -> DataFrame:
    """Rows and characters of text per month, from the sums by class."""
    by_class = state.filter(F.col(GROUPED_BY) == "sentiment_proxy").groupBy("year", "month")
    return by_class.agg(F.sum("row_count").alias("records"), F.sum("sum_avg_comment_length").alias("characters"))


def views_of_summary(summary: DataFrame, spec: FeedSpec = DEFAULT) -> dict[str, DataFrame]:
    return {
        v: summary.filter(F.col(GROUPED_BY) == _key(v, spec))
        .select(*[F.col(m).alias(name) for name, m in _columns(v, spec)])
        .orderBy(*view_order(v, spec))
        for v in VIEWS
    }


# --- top-k and chart tables -------------------------------------------------------------


def dashboard_rows(view: DataFrame, rows: int = DASHBOARD_ROWS) -> DataFrame:
    """Head of an ordered view; Spark plans the sort and the limit as one top-k."""
    return view.limit(rows)


def chart_top_groups(top: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """Bar chart: the first groups by number of comments."""
    return top.select(spec.group, "total_comments").limit(CHART_ROWS)


def chart_hourly(hourly: DataFrame) -> DataFrame:
    """Line chart: comments per hour of day."""
    return hourly.select("hour", "comments")


def chart_sentiment_share(sentiment: DataFrame) -> DataFrame:
    """Pie chart: percent per class. The window sees the three grouped rows, never the table."""
    total = F.sum("count").over(W.partitionBy())
    return sentiment.select(
        "sentiment_proxy", "count", F.round(F.lit(100.0) * F.col("count") / total, 1).alias("share_percent")
    )
