"""Incremental ingest: new landed files in, cleaned rows out, each file once.

Stateless filters and projections in append mode, so there is no state to keep and no
watermark. ``start_analytical`` writes through Spark's file sink and knows its counters while it runs.
``start_committed`` makes each micro-batch a committed run of the job's table: its counters are stored with it and
count once however often the stream stops or a batch is repeated, and its sums by month keep the views up to date.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from threadsift.operators.clean import INGEST_RULES, all_feed_columns, keep_tagged, tag
from threadsift.operators.layout import MONTH_KEY, REBALANCE
from threadsift.operators.quality import after_ingest, extraction_metrics, reject_counts, transformation_metrics
from threadsift.operators.table import RECORD, STATUS, counted_table
from threadsift.plans.job import Paths, commit_run, counters_of
from threadsift.sources import commits as log
from threadsift.sources.readers import stored_files
from threadsift.sources.writers import write_analytical, write_with_rejects
from threadsift.spec import CORRUPT, DEFAULT, FeedSpec

COUNTERS = "stream_counters"
_PATTERN = r"[\[\]{}*?\\\\]"


def stream_feed(
    spark: SparkSession,
    path: str,
    format: str = "json",
    spec: FeedSpec = DEFAULT,
    fields: tuple[str, ...] | None = None,
    files_per_batch: int | None = 1000,
    bytes_per_batch: int | None = None,
    parquet_schema: StructType | None = None,
) -> DataFrame:
    """The raw feed as a stream over a folder of landed files.

    A micro-batch is bounded by files or by bytes, which a backlog needs. File names with pattern
    characters such as ``[`` are refused when the run starts: Spark's file stream takes them for
    patterns and may read a file twice or not at all.
    """
    odd = stored_files(spark, path).filter(F.regexp_like(F.url_decode(F.element_at(F.split("file", "/"), -1)), F.lit(_PATTERN)))
    if name := odd.select("file").first():
        raise ValueError(f"a file name with pattern characters: {name[0]}")
    reader = spark.readStream.format(format)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    elif files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if format == "json":
        reader = (
            reader.schema(spec.raw_schema(fields))
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
        )
    else:
        reader = reader.schema(parquet_schema or spec.raw_schema(fields, corrupt=False))
    return reader.load(path)


def stream_ingest_clean(raw: DataFrame, spec: FeedSpec = DEFAULT) -> DataFrame:
    """The ingest rules with counters; the batch counterpart is ``ingest_clean``."""
    tagged = tag(raw, INGEST_RULES, spec, drop_empty=True)
    counted = tagged.observe(COUNTERS, *reject_counts(INGEST_RULES))
    return all_feed_columns(keep_tagged(counted), spec)


def stream_analytical(
    raw: DataFrame, spec: FeedSpec = DEFAULT, drop_empty: bool = True, layout: str = REBALANCE
) -> DataFrame:
    """Ingest rules, conversions and features in one step, with counters.

    Each micro-batch is laid out by month as in the batch job, so it adds few files.
    """
    return counted_table(raw, COUNTERS, spec, drop_empty, layout)


def start_landing(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Lands a cleaned stream as JSON Lines, one pass over what has arrived."""
    return (
        stream.writeStream.format("json")
        .option("ignoreNullFields", "false")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def start_analytical(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends an analytical stream to the Parquet layout by year and month."""
    return (
        stream.writeStream.format("parquet")
        .partitionBy(*MONTH_KEY)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def stream_name(checkpoint: str) -> str:
    """How the runs of a stream begin: a name of its checkpoint, which stays the same over restarts."""
    return f"stream-{hashlib.sha256(checkpoint.rstrip('/').encode()).hexdigest()[:16]}"


def start_committed(
    raw: DataFrame,
    root: str,
    checkpoint: str,
    spec: FeedSpec = DEFAULT,
    drop_empty: bool = True,
    layout: str = REBALANCE,
    quarantine: bool = False,
) -> StreamingQuery:
    """Adds a raw stream to the table below ``root``, a run for each micro-batch, one pass over what has arrived.

    The checkpoint fixes which files a batch has before it is worked on, so a batch that is repeated after a loss is
    the same; if it was already committed nothing is done. Cleaning and counting are those of the batch job.
    """
    name = stream_name(checkpoint)

    def add(batch: DataFrame, number: int) -> None:
        spark, paths = batch.sparkSession, Paths(root.rstrip("/"), f"{name}-{number:012}")
        if log.log_table(spark, paths.root).filter(F.col("run") == paths.run).count():
            return
        observation = Observation(COUNTERS)
        table = counted_table(batch, observation, spec, drop_empty, layout, quarantine=quarantine)
        if quarantine:
            write_with_rejects(table, paths.run_table)
            table = table.drop(STATUS, RECORD)
        else:
            write_analytical(table, paths.analytical)
        counts = observation.get
        metrics = {"extraction": extraction_metrics(counts), "transformation": transformation_metrics(after_ingest(counts))}
        commit_run(spark, paths, log.APPEND, tuple(table.columns), counters_of(metrics), spec)

    return raw.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_totals(spark: SparkSession, root: str, checkpoint: str) -> DataFrame:
    """(counter, value) over all micro-batches that a stream has ever committed."""
    own = log.ledger(spark, root.rstrip("/")).filter(F.col("run").startswith(f"{stream_name(checkpoint)}-"))
    return own.groupBy("counter").agg(F.sum("value").alias("value"))


def finish(query: StreamingQuery, poll_seconds: int = 1) -> dict[str, int]:
    """Waits for the run and sums its counters over all micro-batches.

    Progress keeps only the latest batches, so it is read while the query runs.
    """
    batches: dict[int, dict[str, int]] = {}

    def collect() -> None:
        for progress in query.recentProgress:
            counts = progress.observedMetrics.get(COUNTERS)
            if counts is not None:
                batches[progress.batchId] = counts.asDict()

    while not query.awaitTermination(poll_seconds):
        collect()
    collect()
    totals: dict[str, int] = {}
    for counts in batches.values():
        for name, value in counts.items():
            totals[name] = totals.get(name, 0) + value
    return totals
