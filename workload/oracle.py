"""The same queries in SQL, written apart from the Spark code."""

from __future__ import annotations

from workload.queries import BROKEN_EVERY, LIMIT_ROWS, LOOKED_UP

_FEED = r"""
feed AS (
  SELECT 'c' || CAST(d.doc_id AS VARCHAR) AS id,
         CASE WHEN d.doc_id % 37 = 0 THEN NULL
              WHEN d.doc_id % 41 = 0 THEN '[deleted]'
              WHEN d.doc_id % 43 = 0 THEN '[Removed]'
              WHEN d.doc_id % 47 = 0 THEN ''
              ELSE d.text END AS body,
         CASE WHEN d.doc_id % 53 = 0 THEN 'n/a'
              WHEN d.doc_id % 61 = 0 THEN NULL
              ELSE CAST(CAST(floor(e.value) AS BIGINT) % 41 - 15 AS VARCHAR) END AS score,
         CASE WHEN d.doc_id % 59 = 0 THEN 'bad'
              ELSE CAST(CAST(floor(epoch(o.o_orderdate)) AS BIGINT)
                        + CAST(floor(epoch(e.ts)) AS BIGINT) % 86400 AS VARCHAR) END AS created_utc,
         CASE WHEN d.doc_id % 67 = 0 THEN NULL ELSE d.source END AS subreddit,
         d.lang AS subreddit_id,
         'u' || CAST(e.user_id AS VARCHAR) AS author,
         CAST(l.toxic AS VARCHAR) AS controversiality
  FROM documents d
  JOIN events e ON e.event_id = d.doc_id
  JOIN orders o ON o.o_orderkey = d.doc_id
  LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""

_INGESTED = """
ingested AS (
  SELECT * FROM feed
  WHERE body IS NOT NULL AND body <> '' AND lower(body) NOT IN ('[deleted]', '[removed]')
)"""

_CLEANED = """
cleaned AS (
  SELECT * FROM feed WHERE body IS NOT NULL AND lower(body) NOT IN ('[deleted]', '[removed]')
)"""

_TYPED = """
typed AS (
  SELECT * FROM (
    SELECT *, TRY_CAST(created_utc AS BIGINT) AS created_utc_long, TRY_CAST(score AS DOUBLE) AS score_num
    FROM cleaned
  ) WHERE created_utc_long IS NOT NULL AND score_num IS NOT NULL
)"""

_ANALYTICAL = r"""
featured AS (
  SELECT *, make_timestamp(created_utc_long * 1000000) AS created_ts,
         CAST(length(body) AS INTEGER) AS comment_length,
         CAST(len(regexp_split_to_array(body, '\s+')) AS INTEGER) AS word_count
  FROM typed
),
analytical AS (
  SELECT id, subreddit, subreddit_id, author, created_ts, created_utc_long,
         CAST(year(created_ts) AS INTEGER) AS year,
         CAST(month(created_ts) AS INTEGER) AS month,
         CAST(day(created_ts) AS INTEGER) AS day,
         CAST(hour(created_ts) AS INTEGER) AS hour,
         CAST(dayofweek(created_ts) + 1 AS INTEGER) AS day_of_week,
         score_num, comment_length, word_count,
         CASE WHEN comment_length > 500 THEN 1 ELSE 0 END AS is_long_comment,
         CASE WHEN controversiality = '1' THEN 1 ELSE 0 END AS is_controversial,
         score_num / (comment_length + 1) AS engagement_rate,
         CASE WHEN score_num > 5 THEN 'positive' WHEN score_num < -5 THEN 'negative' ELSE 'neutral' END
           AS sentiment_proxy,
         body
  FROM featured
)"""

_FULL = ",".join((_FEED, _CLEANED, _TYPED, _ANALYTICAL))


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def _over_table(select: str) -> str:
    return _with(_FULL, select)


_TABLE = """SELECT id, subreddit, subreddit_id, author, created_ts, created_utc_long, year, month, day, hour,
  day_of_week, score_num, comment_length, word_count, is_long_comment, is_controversial,
  round(engagement_rate, 9) AS engagement_rate, sentiment_proxy, body FROM analytical"""

_TOP = """SELECT subreddit, count(*) AS total_comments, round(avg(score_num), 9) AS avg_score,
  round(avg(comment_length), 9) AS avg_comment_length, sum(score_num) AS total_score,
  round(avg(engagement_rate), 9) AS avg_engagement
FROM analytical GROUP BY subreddit ORDER BY total_comments DESC, subreddit ASC NULLS LAST"""

_ENGAGEMENT = """SELECT subreddit, round(avg(engagement_rate), 9) AS avg_engagement,
  CAST(sum(is_controversial) AS BIGINT) AS controversial_count, round(avg(word_count), 9) AS avg_words
FROM analytical GROUP BY subreddit ORDER BY avg(engagement_rate) DESC, subreddit ASC NULLS LAST"""

_HOURLY = """SELECT hour, count(*) AS comments, round(avg(score_num), 9) AS avg_score
FROM analytical GROUP BY hour ORDER BY hour"""

_SENTIMENT = """SELECT sentiment_proxy, count(*) AS count FROM analytical GROUP BY sentiment_proxy"""

_MONTHS = "SELECT year, month, count(*) AS records FROM analytical GROUP BY year, month"

_MEASURES = """count(*) AS row_count, round(avg(score_num), 9) AS avg_score,
  round(avg(comment_length), 9) AS avg_comment_length, sum(score_num) AS total_score,
  round(avg(engagement_rate), 9) AS avg_engagement,
  CAST(sum(is_controversial) AS BIGINT) AS controversial_count, round(avg(word_count), 9) AS avg_words"""

_SUMMARY = f"""SELECT 'subreddit' AS grouped_by, subreddit AS key, {_MEASURES} FROM analytical GROUP BY subreddit
UNION ALL SELECT 'hour', CAST(hour AS VARCHAR), {_MEASURES} FROM analytical GROUP BY hour
UNION ALL SELECT 'sentiment_proxy', sentiment_proxy, {_MEASURES} FROM analytical GROUP BY sentiment_proxy"""

# Groups by author, of which there are many more than fifty.
_TOP_AUTHORS, _ENGAGED_AUTHORS = (x.replace("subreddit", "author") + " LIMIT 50" for x in (_TOP, _ENGAGEMENT))

_NO_SCORE = _TYPED.replace("TRY_CAST(score AS DOUBLE) AS score_num", "CAST(0 AS DOUBLE) AS score_num")
_NO_TIME = _TYPED.replace("TRY_CAST(created_utc AS BIGINT) AS created_utc_long", "CAST(NULL AS BIGINT) AS created_utc_long").replace(
    "created_utc_long IS NOT NULL AND ", ""
)
_NO_FLAG = _ANALYTICAL.replace("controversiality = '1'", "false")

# The job's cleaning stage reads what ingest has landed, so empty texts are gone there.
_JOB_FULL = ",".join((_FEED, _INGESTED, _CLEANED.replace("FROM feed", "FROM ingested"), _TYPED, _ANALYTICAL))

_QUALITY = f"""SELECT 'extraction' AS stage, 'total_records' AS metric, CAST(count(*) AS DOUBLE) AS value FROM ingested
UNION ALL SELECT 'extraction', 'corrupt_records', count(*) FROM feed
  WHERE CAST(substr(id, 2) AS BIGINT) % {BROKEN_EVERY} = 0
UNION ALL SELECT 'extraction', 'null_body_records', count(*) FROM feed WHERE body IS NULL OR body = ''
UNION ALL SELECT 'extraction', 'deleted_removed_records', count(*) FROM feed
  WHERE lower(body) IN ('[deleted]', '[removed]')
UNION ALL SELECT 'transformation', 'initial_records', count(*) FROM ingested
UNION ALL SELECT 'transformation', 'after_cleaning', count(*) FROM cleaned
UNION ALL SELECT 'transformation', 'cleaning_removed',
  (SELECT count(*) FROM ingested) - (SELECT count(*) FROM cleaned)
UNION ALL SELECT 'transformation', 'corrupt_records', 0.0
UNION ALL SELECT 'transformation', 'null_body_records', count(*) FROM ingested WHERE body IS NULL
UNION ALL SELECT 'transformation', 'deleted_removed_records', count(*) FROM ingested
  WHERE lower(body) IN ('[deleted]', '[removed]')
UNION ALL SELECT 'transformation', 'bad_time_records', count(*) FROM cleaned
  WHERE TRY_CAST(created_utc AS BIGINT) IS NULL
UNION ALL SELECT 'transformation', 'bad_score_records', count(*) FROM cleaned
  WHERE TRY_CAST(created_utc AS BIGINT) IS NOT NULL AND TRY_CAST(score AS DOUBLE) IS NULL
UNION ALL SELECT 'transformation', 'final_records', count(*) FROM analytical
UNION ALL SELECT 'transformation', 'feature_columns', 19.0
UNION ALL SELECT 'persistence', 'parquet_partitions', count(DISTINCT year) FROM analytical
UNION ALL SELECT 'persistence', 'parquet_months', count(DISTINCT year * 100 + month) FROM analytical
UNION ALL SELECT 'persistence', 'csv_files', 4.0
UNION ALL SELECT 'persistence', 'visualizations', 3.0"""

_TOP_AND_ENGAGEMENT = _TOP.replace(
    "AS avg_engagement\n", """AS avg_engagement,
  CAST(sum(is_controversial) AS BIGINT) AS controversial_count, round(avg(word_count), 9) AS avg_words\n""")

_REASON = """CASE WHEN body IS NULL OR body = '' THEN 'null_body_records'
  WHEN lower(body) IN ('[deleted]', '[removed]') THEN 'deleted_removed_records'
  WHEN TRY_CAST(created_utc AS BIGINT) IS NULL THEN 'bad_time_records'
  WHEN TRY_CAST(score AS DOUBLE) IS NULL THEN 'bad_score_records'
  ELSE 'kept' END"""

_REJECTED = f"""SELECT {_REASON} AS reason, *, CAST(NULL AS VARCHAR) AS line FROM feed WHERE {_REASON} <> 'kept'
UNION ALL SELECT 'corrupt_records', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '{{"id": "' || id || '", "body": "cut'
  FROM feed WHERE CAST(substr(id, 2) AS BIGINT) % {BROKEN_EVERY} = 0"""

_REASON_COUNTS = f"""SELECT {_REASON} AS reason, count(*) AS records FROM feed GROUP BY 1
UNION ALL SELECT 'corrupt_records', count(*) FROM feed WHERE CAST(substr(id, 2) AS BIGINT) % {BROKEN_EVERY} = 0 HAVING count(*) > 0"""

def _as_json(view: str, select: str, fields: dict[str, str]) -> str:
    """Rows of a view as JSON text: NULL stays null, the rest is text."""
    row = " || ',' || ".join(f"""'"{n}":' || coalesce('"' || CAST({x} AS VARCHAR) || '"', 'null')""" for n, x in fields.items())
    return f"SELECT '{view}' AS view, '{{' || {row} || '}}' AS row FROM ({select})"


_DASHBOARDS = " UNION ALL ".join(
    (
        _as_json("top_subreddits", _TOP, {"subreddit": "subreddit", "total_comments": "total_comments", "total_score": "total_score"}),
        _as_json("hourly_activity", _HOURLY, {"hour": "hour", "comments": "comments"}),
        _as_json("sentiment_distribution", _SENTIMENT, {"sentiment_proxy": "sentiment_proxy", "count": "count"}),
        _as_json("engagement", _ENGAGEMENT, {"subreddit": "subreddit", "controversial_count": "controversial_count"}),
    )
)

# Of the report only what counts rows, under the names of the ledger.
_LEDGER = f"""SELECT stage || '.' || metric AS counter, CAST(CASE WHEN metric = 'corrupt_records' THEN 0 ELSE value END AS BIGINT) AS value
FROM ({_QUALITY}) WHERE stage <> 'persistence' AND metric <> 'feature_columns'"""

_COUNTERS = """SELECT (SELECT count(*) FROM ingested) AS total_records,
  count(*) FILTER (WHERE body IS NULL OR body = '') AS null_body_records,
  count(*) FILTER (WHERE lower(body) IN ('[deleted]', '[removed]')) AS deleted_removed_records
FROM feed"""

ORACLE: dict[str, str] = {
    "ingest_clean": _with(f"{_FEED},{_INGESTED}", "SELECT * FROM ingested"),
    "ingest_counters": _with(f"{_FEED},{_INGESTED}", _COUNTERS),
    "limit_index": _with(f"{_FEED},{_INGESTED}", _COUNTERS),
    "ingest_limit": _with(
        f"{_FEED},{_INGESTED}",
        f"""SELECT least({LIMIT_ROWS}, count(*)) AS kept_rows, least({LIMIT_ROWS}, count(DISTINCT id)) AS distinct_ids,
  CAST(0 AS BIGINT) AS dirty_rows FROM ingested""",
    ),
    "stream_ingest_clean": _with(f"{_FEED},{_INGESTED}", "SELECT * FROM ingested"),
    "stream_analytical": _with(
        _JOB_FULL,
        """SELECT id, created_utc_long, year, month, score_num, word_count, sentiment_proxy, body FROM analytical""",
    ),
    "parquet_feed_ingest": _with(f"{_FEED},{_INGESTED}", "SELECT * FROM ingested"),
    "jsonl_roundtrip": _with(_FEED, "SELECT * FROM feed"),
    "json_missing_columns": _with(
        f"{_FEED},{_CLEANED}",
        """SELECT id, subreddit, CAST(0 AS DOUBLE) AS score_num, 0 AS is_controversial,
  'neutral' AS sentiment_proxy, CAST(length(body) AS INTEGER) AS comment_length, 1 AS no_time, 1 AS no_year
FROM cleaned""",
    ),
    "json_without_score": _with(",".join((_FEED, _CLEANED, _NO_SCORE, _ANALYTICAL)), _TABLE),
    "json_without_time": _with(",".join((_FEED, _CLEANED, _NO_TIME, _ANALYTICAL)), _TABLE),
    "json_without_flag": _with(",".join((_FEED, _CLEANED, _TYPED, _NO_FLAG)), _TABLE),
    "clean_filters": _with(f"{_FEED},{_CLEANED}", "SELECT * FROM cleaned"),
    "typed_casts": _with(
        f"{_FEED},{_CLEANED},{_TYPED}", "SELECT id, created_utc_long, score_num FROM typed"
    ),
    "reject_reasons": _with(
        _FEED,
        """SELECT CASE WHEN body IS NULL THEN 'null_body_records'
  WHEN lower(body) IN ('[deleted]', '[removed]') THEN 'deleted_removed_records'
  WHEN TRY_CAST(created_utc AS BIGINT) IS NULL THEN 'bad_time_records'
  WHEN TRY_CAST(score AS DOUBLE) IS NULL THEN 'bad_score_records'
  ELSE 'kept' END AS reason, count(*) AS records FROM feed GROUP BY 1""",
    ),
    "features_text": _over_table("SELECT id, comment_length, word_count FROM analytical"),
    "features_temporal": _over_table(
        "SELECT id, created_ts, year, month, day, hour, day_of_week FROM analytical"
    ),
    "features_flags": _over_table("SELECT id, is_long_comment, is_controversial FROM analytical"),
    "engagement_rate": _over_table("SELECT id, round(engagement_rate, 9) AS engagement_rate FROM analytical"),
    "sentiment_class": _over_table("SELECT id, score_num, sentiment_proxy FROM analytical"),
    "analytical_table": _over_table(_TABLE),
    "top_groups": _over_table(_TOP),
    "top_groups_50": _over_table(_TOP_AUTHORS),
    "hourly_activity": _over_table(_HOURLY),
    "sentiment_distribution": _over_table(_SENTIMENT),
    "engagement": _over_table(_ENGAGEMENT),
    "engagement_50": _over_table(_ENGAGED_AUTHORS),
    "view_summary": _over_table(_SUMMARY),
    "chart_top20": _over_table(f"SELECT subreddit, total_comments FROM ({_TOP} LIMIT 20)"),
    "chart_hourly": _over_table("SELECT hour, count(*) AS comments FROM analytical GROUP BY hour"),
    "chart_sentiment_share": _over_table(
        f"""SELECT sentiment_proxy, count, round(100.0 * count / (SELECT count(*) FROM analytical), 1) AS share_percent
FROM ({_SENTIMENT})"""
    ),
    "parquet_partition_roundtrip": _over_table(_TABLE),
    "parquet_month_counts": _over_table(_MONTHS),
    "parquet_one_year": _over_table(
        """SELECT month, sentiment_proxy, count(*) AS records FROM analytical WHERE year = 1997
GROUP BY month, sentiment_proxy"""
    ),
    "parquet_as_read": _over_table(_TABLE),
    "csv_hourly": _over_table(_HOURLY),
    "csv_roundtrip": _over_table(_TOP),
    "csv_engagement": _over_table(_ENGAGEMENT),
    "csv_sentiment": _over_table(_SENTIMENT),
    "dashboard_top": _over_table(_TOP_AUTHORS.replace(", 9)", ", 10)")),
    "dashboard_hourly": _over_table(_HOURLY.replace(", 9)", ", 10)")),
    "dashboard_sentiment": _over_table(_SENTIMENT),
    "dashboard_json_roundtrip": _over_table(_ENGAGED_AUTHORS.replace(", 9)", ", 10)")),
    "quality_metrics": _with(_JOB_FULL, _QUALITY),
    "full_job_views": _with(_JOB_FULL, _TOP),
    "failed_run_keeps_table": _with(_JOB_FULL, _TABLE),
    "dashboard_single_files": _with(_JOB_FULL, _DASHBOARDS),
    "clustered_groups": _with(_JOB_FULL, f"SELECT id, subreddit, score_num, comment_length FROM analytical WHERE subreddit IN {LOOKED_UP}"),
    "quarantined_rows": _with(_FEED, _REJECTED),
    "quarantine_counts": _with(_FEED, _REASON_COUNTS),
    "incremental_views": _with(_JOB_FULL, _TOP_AND_ENGAGEMENT),
    "incremental_table": _with(_JOB_FULL, _TABLE),
    "stream_counters": _with(_JOB_FULL, _LEDGER),
    "stream_views": _with(_JOB_FULL, _TOP),
}
