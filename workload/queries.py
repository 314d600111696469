"""One query per operator, over whole tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift.operators import clean as c
from threadsift.operators import features as f
from threadsift.operators import views as v
from threadsift.operators.layout import AS_READ
from threadsift.operators.quality import reject_counts
from threadsift.plans import job
from threadsift.sources import commits as log
from threadsift.sources.limit import KeptIndex
from threadsift.sources.readers import read_analytical, read_dashboard_json, read_feed, read_view_csv
from threadsift.sources.scratch import scratch_folder
from threadsift.sources.writers import write_dashboard_json, write_feed_json, write_view_csv
from threadsift.spec import DEFAULT, FeedSpec
from threadsift.streaming import ingest as s
from workload.feed import comment_feed

LIMIT_ROWS = 700
BROKEN_EVERY = 71
LOOKED_UP = ("src3", "src11", "no such group")
# Many more groups than a dashboard shows, with ties at its end.
BY_AUTHOR = FeedSpec(group="author", author="subreddit")
# The addition order of doubles differs between engines.
DIGITS = 9

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name), DIGITS) for name in columns})


def _analytical(spark: SparkSession, sf: str) -> DataFrame:
    return f.analytical_table(comment_feed(spark, sf))


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    return c.clean(comment_feed(spark, sf))


def _landed_feed(spark: SparkSession, sf: str) -> str:
    path = scratch_folder(spark, "feed")
    write_feed_json(comment_feed(spark, sf), path)
    return path


def _landed_with_broken_lines(spark: SparkSession, sf: str) -> str:
    """The landed feed, with a line that is cut off behind every 71st number."""
    path = _landed_feed(spark, sf)
    number = F.substring("id", 2, 20).cast("bigint")
    broken = comment_feed(spark, sf).filter(number % BROKEN_EVERY == 0)
    cut_off = F.format_string('{"id": "%s", "body": "cut', "id")
    broken.select(cut_off.alias("value")).write.mode("append").format("text").save(f"{path}-broken")
    return f"{path}*"


def _rounded_top(df: DataFrame) -> DataFrame:
    return _rounded(df, "avg_score", "avg_comment_length", "avg_engagement")


def _rounded_engagement(df: DataFrame) -> DataFrame:
    return _rounded(df, "avg_engagement", "avg_words")


# --- ingest -----------------------------------------------------------------------------


def ingest_clean(spark: SparkSession, sf: str) -> DataFrame:
    return c.ingest_clean(comment_feed(spark, sf))


def ingest_counters(spark: SparkSession, sf: str) -> DataFrame:
    tagged = c.tag(comment_feed(spark, sf), c.INGEST_RULES, drop_empty=True)
    counts = tagged.agg(*reject_counts(c.INGEST_RULES))
    dropped = F.col(c.NULL_BODY) + F.col(c.PLACEHOLDER) + F.col(c.CORRUPT_RECORD)
    return counts.select((F.col("rows_read") - dropped).alias("total_records"), c.NULL_BODY, c.PLACEHOLDER)


def ingest_limit(spark: SparkSession, sf: str) -> DataFrame:
    path, landed = scratch_folder(spark, "feed"), scratch_folder(spark, "landed")
    write_feed_json(comment_feed(spark, sf).repartition(5), path)  # several files, one of them cut
    job.ingest(spark, path, landed, job.JobOptions(limit=LIMIT_ROWS))
    return read_feed(spark, landed).agg(
        F.count(F.lit(1)).alias("kept_rows"),
        F.count_distinct("id").alias("distinct_ids"),
        F.count_if(c.is_placeholder(F.col("body"), DEFAULT.placeholders) | (F.col("body") == "")).alias("dirty_rows"),
    )


def limit_index(spark: SparkSession, sf: str) -> DataFrame:
    """What an index of kept rows holds behind two limited runs: the counters of all files, once."""
    path, index = scratch_folder(spark, "feed"), scratch_folder(spark, "index")
    write_feed_json(comment_feed(spark, sf).repartition(5), path)
    for limit in (LIMIT_ROWS, 1 << 40):
        job.ingest(spark, path, scratch_folder(spark, "landed"), job.JobOptions(limit=limit, limit_index=index))
    files = KeptIndex(spark, index).files()
    return files.agg(F.sum("kept").alias("total_records"), F.sum(c.NULL_BODY).alias(c.NULL_BODY), F.sum(c.PLACEHOLDER).alias(c.PLACEHOLDER))


def stream_ingest_clean(spark: SparkSession, sf: str) -> DataFrame:
    source, landed = _landed_feed(spark, sf), scratch_folder(spark, "landed")
    stream = s.stream_ingest_clean(s.stream_feed(spark, source, files_per_batch=100))
    s.finish(s.start_landing(stream, landed, scratch_folder(spark, "checkpoint")))
    return read_feed(spark, landed).drop("_corrupt_record")


def stream_analytical(spark: SparkSession, sf: str) -> DataFrame:
    source, table = _landed_feed(spark, sf), scratch_folder(spark, "analytical")
    stream = s.stream_analytical(s.stream_feed(spark, source, files_per_batch=100))
    s.finish(s.start_analytical(stream, table, scratch_folder(spark, "checkpoint")))
    return read_analytical(spark, table).select(
        "id", "created_utc_long", "year", "month", "score_num", "word_count", "sentiment_proxy", "body"
    )


def parquet_feed_ingest(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "feed")
    comment_feed(spark, sf).write.parquet(path)
    return c.ingest_clean(read_feed(spark, path, "parquet"))


# --- scan, projection, casts ------------------------------------------------------------


def jsonl_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return read_feed(spark, _landed_feed(spark, sf)).drop("_corrupt_record")


def json_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "partial")
    write_feed_json(comment_feed(spark, sf).select("id", "body", "subreddit"), path)
    table = f.analytical_table(read_feed(spark, path, fields=("id", "body", "subreddit")))
    return table.select(
        "id",
        "subreddit",
        "score_num",
        "is_controversial",
        "sentiment_proxy",
        "comment_length",
        F.col("created_utc_long").isNull().cast("int").alias("no_time"),
        F.col("year").isNull().cast("int").alias("no_year"),
    )


def _without(spark: SparkSession, sf: str, absent: str) -> DataFrame:
    path = scratch_folder(spark, "partial")
    fields = tuple(x for x in DEFAULT.fields if x != absent)
    write_feed_json(comment_feed(spark, sf).select(*fields), path)
    return _rounded(f.analytical_table(read_feed(spark, path, fields=fields)), "engagement_rate")


def json_without_score(spark: SparkSession, sf: str) -> DataFrame:
    return _without(spark, sf, DEFAULT.score)


def json_without_time(spark: SparkSession, sf: str) -> DataFrame:
    return _without(spark, sf, DEFAULT.event_time)


def json_without_flag(spark: SparkSession, sf: str) -> DataFrame:
    return _without(spark, sf, DEFAULT.flag)


def clean_filters(spark: SparkSession, sf: str) -> DataFrame:
    return comment_feed(spark, sf).transform(c.feed_columns).transform(c.drop_null_text).transform(c.drop_placeholders)


def typed_casts(spark: SparkSession, sf: str) -> DataFrame:
    return _typed(spark, sf).select("id", "created_utc_long", "score_num")


def reject_reasons(spark: SparkSession, sf: str) -> DataFrame:
    typed = c.typed_columns(comment_feed(spark, sf))
    tagged = c.tag(typed, c.CLEANING_RULES + c.CAST_RULES)
    return tagged.groupBy(F.coalesce(c.REJECT, F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("records"))


# --- features ---------------------------------------------------------------------------


def features_text(spark: SparkSession, sf: str) -> DataFrame:
    return f.text_features(_typed(spark, sf)).select("id", "comment_length", "word_count")


def features_temporal(spark: SparkSession, sf: str) -> DataFrame:
    return f.time_features(_typed(spark, sf)).select(
        "id", "created_ts", "year", "month", "day", "hour", "day_of_week"
    )


def features_flags(spark: SparkSession, sf: str) -> DataFrame:
    rows = _typed(spark, sf).transform(f.text_features).transform(f.flag_features)
    return rows.select("id", "is_long_comment", "is_controversial")


def engagement_rate(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_analytical(spark, sf).select("id", "engagement_rate"), "engagement_rate")


def sentiment_class(spark: SparkSession, sf: str) -> DataFrame:
    return _analytical(spark, sf).select("id", "score_num", "sentiment_proxy")


def analytical_table(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_analytical(spark, sf), "engagement_rate")


# --- views ------------------------------------------------------------------------------


def top_groups(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_top(v.top_groups(_analytical(spark, sf)))


def _by_author(spark: SparkSession, sf: str) -> DataFrame:
    return f.analytical_table(comment_feed(spark, sf), BY_AUTHOR)


def top_groups_50(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_top(v.dashboard_rows(v.top_groups(_by_author(spark, sf), BY_AUTHOR)))


def hourly_activity(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(v.hourly_activity(_analytical(spark, sf)), "avg_score")


def sentiment_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return v.sentiment_distribution(_analytical(spark, sf))


def engagement(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_engagement(v.engagement(_analytical(spark, sf)))


def engagement_50(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_engagement(v.dashboard_rows(v.engagement(_by_author(spark, sf), BY_AUTHOR)))


def view_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary = v.view_summary(_analytical(spark, sf))
    key = F.coalesce("subreddit", F.col("hour").cast("string"), "sentiment_proxy").alias("key")
    measures = summary.columns[summary.columns.index("row_count") :]
    keyed = summary.select("grouped_by", key, *measures)
    return _rounded(keyed, "avg_score", "avg_comment_length", "avg_engagement", "avg_words")


def chart_top20(spark: SparkSession, sf: str) -> DataFrame:
    return v.chart_top_groups(v.top_groups(_analytical(spark, sf)))


def chart_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return v.chart_hourly(v.hourly_activity(_analytical(spark, sf)))


def chart_sentiment_share(spark: SparkSession, sf: str) -> DataFrame:
    return v.chart_sentiment_share(v.sentiment_distribution(_analytical(spark, sf)))


# --- sinks and jobs ---------------------------------------------------------------------


def _stored_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "analytical")
    job.transform(comment_feed(spark, sf), path)
    return read_analytical(spark, path)


def parquet_partition_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_stored_table(spark, sf), "engagement_rate")


def parquet_month_counts(spark: SparkSession, sf: str) -> DataFrame:
    return job.stored_months(_stored_table(spark, sf))


def parquet_one_year(spark: SparkSession, sf: str) -> DataFrame:
    table = _stored_table(spark, sf).filter(F.col("year") == 1997)
    return table.groupBy("month", "sentiment_proxy").agg(F.count(F.lit(1)).alias("records"))


def parquet_as_read(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "analytical")
    job.transform(comment_feed(spark, sf), path, job.JobOptions(layout=AS_READ))
    return _rounded(read_analytical(spark, path), "engagement_rate")


def csv_hourly(spark: SparkSession, sf: str) -> DataFrame:
    view = v.hourly_activity(_analytical(spark, sf))
    path = scratch_folder(spark, "csv")
    write_view_csv(view, path, files=1)
    return _rounded(read_view_csv(spark, path, view.schema), "avg_score")


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    view = v.top_groups(_analytical(spark, sf))
    path = scratch_folder(spark, "csv")
    write_view_csv(view, path)
    return _rounded_top(read_view_csv(spark, path, view.schema))


def csv_engagement(spark: SparkSession, sf: str) -> DataFrame:
    view = v.engagement(_analytical(spark, sf))
    path = scratch_folder(spark, "csv")
    write_view_csv(view, path)
    return _rounded_engagement(read_view_csv(spark, path, view.schema))


def csv_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    view = v.sentiment_distribution(_analytical(spark, sf))
    path = scratch_folder(spark, "csv")
    write_view_csv(view, path, files=1)
    return read_view_csv(spark, path, view.schema)


def _dashboard(spark: SparkSession, view: DataFrame, name: str, spec: FeedSpec = DEFAULT) -> DataFrame:
    path = scratch_folder(spark, "dashboard")
    write_dashboard_json(view, v.view_order(name, spec), path)
    return read_dashboard_json(spark, path, view.schema)


def dashboard_top(spark: SparkSession, sf: str) -> DataFrame:
    return _dashboard(spark, v.top_groups(_by_author(spark, sf), BY_AUTHOR), v.TOP_GROUPS, BY_AUTHOR)


def dashboard_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return _dashboard(spark, v.hourly_activity(_analytical(spark, sf)), v.HOURLY)


def dashboard_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return _dashboard(spark, v.sentiment_distribution(_analytical(spark, sf)), v.SENTIMENT)


def dashboard_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _dashboard(spark, v.engagement(_by_author(spark, sf), BY_AUTHOR), v.ENGAGEMENT, BY_AUTHOR)


def dashboard_single_files(spark: SparkSession, sf: str) -> DataFrame:
    """All four dashboards of a job as the files that bear their names."""
    result = job.run_job(spark, _landed_feed(spark, sf), scratch_folder(spark, "job"), job.JobOptions(single_files=True))
    if not result.ok:
        raise result.error
    kinds = {name: view.schema for name, view in job.read_views(spark, result.paths.root).items()}
    parts = []
    for name, kind in kinds.items():
        # the file's own name, not that of a part in a folder
        path = result.paths.dashboard(name)
        rows = read_dashboard_json(spark, path, kind).filter(F.col("_metadata.file_name") == path.rpartition("/")[2])
        fields = F.to_json(F.struct(*[F.col(x).cast("string").alias(x) for x in kind.names if not x.startswith("avg")]), {"ignoreNullFields": "false"})
        parts.append(rows.select(F.lit(name).alias("view"), fields.alias("row")))
    return reduce(DataFrame.unionByName, parts)


def quality_metrics(spark: SparkSession, sf: str) -> DataFrame:
    source = _landed_with_broken_lines(spark, sf)
    result = job.run_job(spark, source, scratch_folder(spark, "job"))
    if not result.ok:
        raise result.error
    metrics = result.quality.to_dataframe(spark)
    return metrics.filter(F.col("metric") != "file_size_mb")


def failed_run_keeps_table(spark: SparkSession, sf: str) -> DataFrame:
    """A run over a feed without scores fails behind a good one; what is read is the good run's table."""
    output, source, bad = scratch_folder(spark, "job"), _landed_feed(spark, sf), scratch_folder(spark, "feed")
    first = job.run_job(spark, source, output)
    if not first.ok:
        raise first.error
    write_feed_json(comment_feed(spark, sf).drop(DEFAULT.score), bad)
    if job.run_job(spark, bad, output).ok:
        raise RuntimeError("a feed without scores went through")
    return _rounded(job.read_table(spark, output), "engagement_rate")


def _kept_aside(spark: SparkSession, sf: str) -> str:
    output = scratch_folder(spark, "job")
    result = job.run_job(spark, _landed_with_broken_lines(spark, sf), output, job.JobOptions(quarantine=True))
    if not result.ok:
        raise result.error
    return output


def quarantined_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected rows from storage, with their fields read back from the stored record; of broken lines the line."""
    rejected = log.read_rejects(spark, _kept_aside(spark, sf))
    fields = F.from_json("record", DEFAULT.raw_schema(corrupt=False))
    broken = F.col("reject") == c.CORRUPT_RECORD
    # the start of a broken line would be read as a record with what there is of it
    value = lambda name: F.when(~broken, fields[name]).alias(name)
    return rejected.select(F.col("reject").alias("reason"), *map(value, DEFAULT.fields), F.when(broken, F.col("record")).alias("line"))


def quarantine_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The counters once more, from what is stored: rows of the table and rejected rows by reason."""
    output = _kept_aside(spark, sf)
    reasons = log.read_rejects(spark, output).groupBy(F.col("reject").alias("reason")).agg(F.count(F.lit(1)).alias("records"))
    kept = job.read_table(spark, output).groupBy(F.lit("kept").alias("reason")).agg(F.count(F.lit(1)).alias("records"))
    return reasons.unionByName(kept)


HOT_MONTH = "1325376000"


def clustered_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Single groups of one month, looked up in a clustered table whose rows all lie in that month."""
    source, output = scratch_folder(spark, "feed"), scratch_folder(spark, "job")
    feed = comment_feed(spark, sf).withColumn(DEFAULT.event_time, F.when(F.col(DEFAULT.event_time).rlike(r"^\d+$"), HOT_MONTH).otherwise("bad"))
    write_feed_json(feed, source)
    result = job.run_job(spark, source, output, job.JobOptions(cluster=True, row_group_bytes=1 << 16))
    if not result.ok:
        raise result.error
    table = job.read_table(spark, output).filter("year = 2012 and month = 1")
    wanted = table.filter(F.col(DEFAULT.group).isin(*LOOKED_UP))
    return wanted.select("id", "subreddit", "score_num", "comment_length")


def _in_increments(spark: SparkSession, sf: str) -> str:
    """The table in three runs: odd years, even years with wrong scores, and the months of the even years once more.

    Scores that do not convert stay as they are: a month without a row to keep would replace nothing."""
    output = scratch_folder(spark, "job")
    feed = comment_feed(spark, sf)
    year = F.year(F.timestamp_add("SECOND", F.col(DEFAULT.event_time).try_cast("bigint"), F.lit("1970-01-01").cast("timestamp_ntz")))
    even = F.coalesce(year % 2 == 0, F.lit(True))
    score = F.col(DEFAULT.score)
    wrong = feed.filter(even).withColumn(DEFAULT.score, F.when(score.try_cast("double").isNotNull(), "99").otherwise(score))
    for part, mode in ((feed.filter(~even), "overwrite"), (wrong, "append"), (feed.filter(even), "overwrite_months")):
        source = scratch_folder(spark, "feed")
        write_feed_json(part, source)
        result = job.run_job(spark, source, output, job.JobOptions(mode=mode))
        if not result.ok:
            raise result.error
    return output


def incremental_views(spark: SparkSession, sf: str) -> DataFrame:
    views = job.read_views(spark, _in_increments(spark, sf))
    top = _rounded_top(views[v.TOP_GROUPS])
    engaged = _rounded_engagement(views[v.ENGAGEMENT]).withColumnRenamed("subreddit", "_group")
    return top.join(engaged.drop("avg_engagement"), top["subreddit"].eqNullSafe(engaged["_group"])).drop("_group")


def incremental_table(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(job.read_table(spark, _in_increments(spark, sf)), "engagement_rate")


def _stopped_and_restarted(spark: SparkSession, sf: str) -> tuple[str, str]:
    """A committed stream that is stopped behind its first micro-batch and started again."""
    source, output, checkpoint = (scratch_folder(spark, x) for x in ("feed", "job", "checkpoint"))
    write_feed_json(comment_feed(spark, sf).repartition(6), source)
    start = lambda: s.start_committed(s.stream_feed(spark, source, files_per_batch=2), output, checkpoint)
    first = start()
    while first.isActive and not first.recentProgress:
        time.sleep(0.05)
    first.stop()
    s.finish(start())
    return output, checkpoint


def stream_counters(spark: SparkSession, sf: str) -> DataFrame:
    return s.stream_totals(spark, *_stopped_and_restarted(spark, sf))


def stream_views(spark: SparkSession, sf: str) -> DataFrame:
    output, _ = _stopped_and_restarted(spark, sf)
    job.compact(spark, output)
    return _rounded_top(job.read_views(spark, output)[v.TOP_GROUPS])


def full_job_views(spark: SparkSession, sf: str) -> DataFrame:
    options = job.JobOptions(land=True)
    result = job.run_job(spark, _landed_feed(spark, sf), scratch_folder(spark, "job"), options)
    if not result.ok:
        raise result.error
    views = v.views_of_summary(spark.read.parquet(result.paths.view_summary))
    return _rounded_top(views[v.TOP_GROUPS])


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        ingest_clean,
        ingest_counters,
        ingest_limit,
        limit_index,
        stream_ingest_clean,
        stream_analytical,
        parquet_feed_ingest,
        jsonl_roundtrip,
        json_missing_columns,
        json_without_score,
        json_without_time,
        json_without_flag,
        clean_filters,
        typed_casts,
        reject_reasons,
        features_text,
        features_temporal,
        features_flags,
        engagement_rate,
        sentiment_class,
        analytical_table,
        top_groups,
        top_groups_50,
        hourly_activity,
        sentiment_distribution,
        engagement,
        engagement_50,
        view_summary,
        chart_top20,
        chart_hourly,
        chart_sentiment_share,
        parquet_partition_roundtrip,
        parquet_month_counts,
        parquet_one_year,
        parquet_as_read,
        csv_roundtrip,
        csv_hourly,
        csv_engagement,
        csv_sentiment,
        dashboard_top,
        dashboard_hourly,
        dashboard_sentiment,
        dashboard_json_roundtrip,
        quality_metrics,
        full_job_views,
        failed_run_keeps_table,
        dashboard_single_files,
        clustered_groups,
        quarantined_rows,
        quarantine_counts,
        incremental_views,
        incremental_table,
        stream_counters,
        stream_views,
    )
}
