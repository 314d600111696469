"""The full job: ingest, transform, persist, report.

Each stage reads the table the stage before it has written, so a lost executor costs at most
the running stage. The feed is parsed once, or twice when a copy is landed first.

A run writes its table, its sums by month and its results into folders of its own and commits them with one line in
the log (``sources/commits.py``); only then are the results moved to their stated names. So a run that fails
leaves the table, the views and the reports of the run before as they were.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threadsift.operators import views as v
from threadsift.operators.clean import INGEST_RULES, all_feed_columns, feed_columns, keep_tagged, tag, typed_columns
from threadsift.operators.features import month_columns
from threadsift.operators.layout import MONTH_KEY, REBALANCE, Pieces, by_month, measured_pieces, needs_no_pieces
from threadsift.operators.quality import (
    QualityMetrics,
    after_ingest,
    extraction_metrics,
    fields_without_values,
    reject_counts,
    transformation_metrics,
)
from threadsift.operators.table import RECORD, STATUS, counted_table
from threadsift.sources import commits as log
from threadsift.sources.files import exists, has_data, make_folder, replace as move
from threadsift.sources.limit import KeptIndex, find_cut, read_to_cut
from threadsift.sources.readers import (
    DETECT,
    as_path,
    detect_fields,
    input_bytes,
    read_analytical,
    read_feed,
    stored_bytes,
    stored_files,
)
from threadsift.sources.writers import (
    ROW_GROUP_BYTES,
    clustered,
    write_analytical,
    write_chart_table,
    write_dashboard_json,
    write_feed_json,
    write_view_csv,
    write_view_summary,
    write_with_rejects,
)
from threadsift.spec import DEFAULT, FeedSpec

_WRITES_AT_ONCE = 4
# Files that month sizes are taken from, and bytes of a row besides its text.
_FEWEST_SAMPLED, _MOST_SAMPLED, _ROW_BYTES = 8, 256, 100


@dataclass(frozen=True)
class JobOptions:
    spec: FeedSpec = DEFAULT
    source_format: str = "json"
    # The fields a JSON feed carries. None assumes all eight and fails when one that rows depend on
    # has no value anywhere; "detect" looks for them in a pass of its own.
    fields: tuple[str, ...] | str | None = None
    limit: int | None = None
    # Where counts of kept rows by file are stored for later runs with a limit; of the same feed and rules.
    limit_index: str | None = None
    # Land a slim copy of the feed first. Worth its two extra passes for a source that is slow
    # or will not stay; files already on shared storage go straight into the transform.
    land: bool = False
    layout: str = REBALANCE
    partitions: int | None = None
    # What a run does to the table of the runs before: overwrite, append or overwrite_months.
    mode: str = "overwrite"
    # Committed runs that no longer count but stay, for those who still read them; None keeps all.
    keep_runs: int | None = 1
    # Keep rejected rows, with their reason and the record as it was read, beside the table; needs the feed itself, so
    # neither a landed copy nor a limit.
    quarantine: bool = False
    # Dashboards and reports as files of the stated names; else a name is a folder that holds the file.
    single_files: bool = False
    # Order each file by group and time, with Bloom filters on group and id, for tables that are asked for single groups.
    cluster: bool = False
    row_group_bytes: int = ROW_GROUP_BYTES
    # Files per summary of the views that grow with the number of groups; None leaves it
    # to the sort. The bounded views always get one.
    group_view_files: int | None = None

    def write_settings(self, columns: list[str]) -> dict[str, str]:
        looked_up = tuple(c for c in (self.spec.group, self.spec.id) if c in columns)
        return clustered(looked_up, self.row_group_bytes) if self.cluster else {}


CHARTS = ("top20_groups", "hourly_activity", "sentiment_distribution")


@dataclass(frozen=True)
class Paths:
    """Everything a run writes below one output folder. The table and its sums are the run's own; results have
    stated names, below ``staged`` until the run is committed."""

    root: str
    run: str
    out: str = ""

    def staged(self) -> Paths:
        return replace(self, out=log.run_folder(self.root, "staged", self.run))

    @property
    def run_table(self) -> str:
        return log.run_folder(self.root, "analytical", self.run)

    @property
    def analytical(self) -> str:
        return f"{self.run_table}/{log.KEPT_FOLDER}"

    @property
    def state(self) -> str:
        return log.run_folder(self.root, "state", self.run)

    def _result(self, name: str) -> str:
        return f"{self.out or self.root}/{name}"

    @property
    def landed(self) -> str:
        return self._result("raw")

    @property
    def view_summary(self) -> str:
        return self._result("view_summary")

    def summary(self, view: str) -> str:
        return self._result(f"summaries/{view}")

    def dashboard(self, view: str) -> str:
        return self._result(f"dashboard_data/{view}.json")

    def chart(self, name: str) -> str:
        return self._result(f"chart_data/{name}")

    @property
    def quality_table(self) -> str:
        return self._result("quality_reports/metrics")

    def report(self, failed: bool = False) -> str:
        return self._result(f"quality_reports/pipeline_quality{'_failed' if failed else ''}.json")

    def results(self) -> list[str]:
        """All results but the landed copy."""
        per_view = [place(x) for x in v.VIEWS for place in (self.summary, self.dashboard)]
        return [self.view_summary, *per_view, *[self.chart(c) for c in CHARTS], self.quality_table, self.report()]


@dataclass
class JobResult:
    ok: bool
    paths: Paths
    quality: QualityMetrics
    error: Exception | None = field(default=None)

    def __bool__(self) -> bool:
        return self.ok


@dataclass(frozen=True)
class _Source:
    """The feed behind a path: tagged by the ingest rules, or only the rows to keep."""

    spark: SparkSession
    path: str
    options: JobOptions

    def raw(self, paths: list[str] | None = None) -> DataFrame:
        o = self.options
        return read_feed(self.spark, paths or [self.path], o.source_format, o.spec, o.fields)

    def with_known_fields(self) -> _Source:
        o = self.options
        if o.fields != DETECT:
            return self
        found = detect_fields(self.spark, self.path, o.spec) if o.source_format == "json" else None
        return replace(self, options=replace(o, fields=found))

    def check_columns(self) -> None:
        """Fails before any work when the feed lacks what the table or the views need."""
        spec, columns = self.options.spec, self.raw().columns
        missing = [c for c in (spec.text, spec.group) if c not in columns]
        if missing:
            raise ValueError(f"the feed has no column {' and no column '.join(missing)}")

    def tagged(self, paths: list[str] | None = None) -> DataFrame:
        return tag(self.raw(paths), INGEST_RULES, self.options.spec, drop_empty=True)

    def kept(self, paths: list[str] | None = None, where: Column | None = None, with_block: bool = False) -> DataFrame:
        raw = self.raw(paths) if where is None else self.raw(paths).filter(where)
        block = F.col("_metadata.file_block_start").alias("_block")
        kept = keep_tagged(tag(raw.select(block, "*") if with_block else raw, INGEST_RULES, self.options.spec, drop_empty=True))
        return kept.select("_block") if with_block else kept.transform(feed_columns, self.options.spec)

    def pieces(self, source_bytes: int) -> Pieces | None:
        """How to cut the months of the feed, from their shares of some of its files; None for a layout that does not ask.

        The files are chosen by a hash of their names, so that order in time does not matter, and make up at most an
        eighth of a feed of many files. Of them only the time and the length of the text are parsed.
        """
        spec, spark = self.options.spec, self.spark
        if self.options.layout != REBALANCE or spec.event_time not in self.raw().columns:
            return None
        if needs_no_pieces(spark, source_bytes):
            return Pieces()
        files = stored_files(spark, self.path)
        number = min(_MOST_SAMPLED, max(_FEWEST_SAMPLED, files.count() // 1000))
        some = files.orderBy(F.xxhash64("file"), "file").limit(number).collect()
        rows = typed_columns(self.raw([as_path(f["file"]) for f in some]), spec).transform(month_columns)
        size = F.coalesce(F.octet_length(spec.text), F.lit(0)) + _ROW_BYTES
        found = {(r["year"], r["month"]): r["n"] for r in rows.groupBy("year", "month").agg(F.sum(size).alias("n")).collect()}
        total = sum(found.values())
        return measured_pieces(spark, {m: n / total * source_bytes for m, n in found.items()}) if total else None

    def first_rows(self, limit: int) -> tuple[DataFrame, dict[str, float]]:
        """The first kept rows and the metrics of the files they came from."""
        index = KeptIndex(self.spark, self.options.limit_index) if self.options.limit_index else None
        cut = find_cut(self.tagged, stored_files(self.spark, self.path), limit, index)
        rows = read_to_cut(self.spark, self.kept, cut, index)
        metrics = extraction_metrics(cut.counts)
        metrics["total_records"] = min(metrics["total_records"], limit)
        metrics["file_size_mb"] = round(cut.bytes / 1024 / 1024, 2)
        return self.kept().limit(0) if rows is None else rows, metrics


def _megabytes(spark: SparkSession, path: str | list[str]) -> float:
    return round(stored_bytes(spark, path) / 1024 / 1024, 2)


def ingest(
    spark: SparkSession,
    source: str,
    landed: str,
    options: JobOptions = JobOptions(),
    quality: QualityMetrics | None = None,
) -> None:
    """Drops rows without text and placeholders, keeps eight fields, lands JSON Lines.

    One pass without a shuffle. With a limit the counters cover the files that were read.
    """
    feed = _Source(spark, source, options)
    if options.limit is None:
        observation = Observation("extraction")
        counted = feed.tagged().observe(observation, *reject_counts(INGEST_RULES))
        write_feed_json(all_feed_columns(keep_tagged(counted), options.spec), landed)
        metrics = extraction_metrics(observation.get)
    else:
        rows, metrics = feed.first_rows(options.limit)
        write_feed_json(all_feed_columns(rows, options.spec), landed)
    if quality is not None:
        quality.add_metrics("extraction", metrics)
        quality.add_metric("extraction", "file_size_mb", _megabytes(spark, landed))


def _needed(spec: FeedSpec) -> tuple[str, ...]:
    return (spec.text, spec.score, spec.event_time, spec.group)


def _refuse(empty: list[str]) -> None:
    if empty:
        raise ValueError(f"no row has a value in {', '.join(empty)}: name the fields that the feed carries")


def _check_values(raw: DataFrame, spec: FeedSpec) -> None:
    """Looks for a value of each needed field, up to the first; where something would be overwritten."""
    empty = [f for f in _needed(spec) if f in raw.columns and raw.filter(F.col(f).isNotNull()).isEmpty()]
    if empty and not raw.isEmpty():
        _refuse(empty)


def transform(
    raw: DataFrame,
    analytical: str,
    options: JobOptions = JobOptions(),
    quality: QualityMetrics | None = None,
    unlanded: bool = False,
    source_bytes: int | None = None,
    pieces: Pieces | None = None,
) -> tuple[str, ...]:
    """Raw feed to the stored analytical table, in one pass; returns its columns.

    With ``unlanded`` the ingest rules apply in the same pass, and both stages are reported. Fails
    when a field that rows depend on was assumed to be there and no row has a value in it: then
    every row would be dropped, or go to no group, without a word.
    """
    spec = options.spec
    if options.fields is None and exists(raw.sparkSession, analytical):
        _check_values(raw, spec)
    if pieces is None and source_bytes is None:
        source_bytes = input_bytes(raw)
        pieces = Pieces() if needs_no_pieces(raw.sparkSession, source_bytes) else None
    observation = Observation("transformation")
    table = counted_table(
        raw, observation, spec, unlanded, options.layout, options.partitions, source_bytes, pieces, options.quarantine, options.cluster
    )
    settings = options.write_settings(table.columns)
    if options.quarantine:
        write_with_rejects(table, analytical.removesuffix(f"/{log.KEPT_FOLDER}"), settings)
        table = table.drop(STATUS, RECORD)
    else:
        write_analytical(table, analytical, options.mode, settings)
    counts = observation.get
    if options.fields is None:
        _refuse([f for f in fields_without_values(counts) if f in _needed(spec)])
    if quality is not None:
        if unlanded:
            quality.add_metrics("extraction", extraction_metrics(counts))
            counts = after_ingest(counts)
        quality.add_schema("raw", feed_columns(raw, spec))
        quality.add_schema("analytical", table)
        quality.add_metrics("transformation", transformation_metrics(counts))
        quality.add_metric("transformation", "feature_columns", len(table.columns))
    return tuple(table.columns)


def store_state(spark: SparkSession, analytical: DataFrame, path: str, spec: FeedSpec = DEFAULT) -> DataFrame:
    """The sums by month of a run's table, from one scan of it; stored, so that views never need the table again."""
    v.month_state(analytical, spec).write.mode("overwrite").parquet(path)
    return spark.read.schema(v.state_schema(spec)).parquet(path)


def months_of(state: DataFrame) -> set[log.Month]:
    """The months of a state, at most a few hundred."""
    return {(r["year"], r["month"]) for r in v.months_of_state(state).select("year", "month").collect()}


def summarise(spark: SparkSession, state: DataFrame, summary_path: str, spec: FeedSpec = DEFAULT) -> dict[str, DataFrame]:
    """The four views from the sums by month, by way of a small written summary."""
    summary = v.summary_of_state(state, spec)
    write_view_summary(summary, summary_path)
    return v.views_of_summary(spark.read.schema(summary.schema).parquet(summary_path), spec)


def read_table(spark: SparkSession, output: str, spec: FeedSpec = DEFAULT) -> DataFrame:
    """The analytical table that the committed runs below ``output`` make up."""
    done = log.read_log(spark, output)
    counted = log.live(done)
    columns = {c for commit in done if commit.run in counted for c in commit.columns}
    return log.read_runs(spark, output, "analytical", spec.analytical_schema(tuple(columns) or None), done)


def read_views(spark: SparkSession, output: str, spec: FeedSpec = DEFAULT) -> dict[str, DataFrame]:
    """The four views of that table, from the sums by month that its runs have stored."""
    state = log.read_runs(spark, output, "state", v.state_schema(spec), log.read_log(spark, output))
    return v.views_of_summary(v.summary_of_state(state, spec), spec)


def compact(spark: SparkSession, output: str, options: JobOptions = JobOptions()) -> str:
    """Writes the table of many runs, such as micro-batches, as one run with few files for a month."""
    spec, run, done = options.spec, log.new_run(), log.read_log(spark, output)
    counted, schema = log.live(done), v.state_schema(spec)
    table, paths = read_table(spark, output, spec), Paths(output, run)
    v.added_states(log.read_runs(spark, output, "state", schema, done), spec).write.parquet(paths.state)
    sizes = v.months_of_state(spark.read.schema(schema).parquet(paths.state)).collect()
    pieces = measured_pieces(spark, {(r["year"], r["month"]): r["characters"] + _ROW_BYTES * r["records"] for r in sizes}, whole=True)
    salt, cluster = (spec.id,) if spec.id in table.columns else (), options.cluster and spec.group in table.columns
    placed = by_month(table, options.layout, options.partitions, salt, pieces, spec.group if cluster else None)
    if cluster:
        placed = placed.sortWithinPartitions(*MONTH_KEY, spec.group, "created_utc_long")
    write_analytical(placed, paths.analytical, options=options.write_settings(table.columns))
    log.commit(spark, output, run, log.OVERWRITE, set().union(*counted.values()), tuple(table.columns), {})
    return run


def chart_tables(views: dict[str, DataFrame], spec: FeedSpec = DEFAULT) -> dict[str, DataFrame]:
    top, hourly, sentiment = CHARTS
    return {
        top: v.chart_top_groups(views[v.TOP_GROUPS], spec),
        hourly: v.chart_hourly(views[v.HOURLY]),
        sentiment: v.chart_sentiment_share(views[v.SENTIMENT]),
    }


def persist_views(
    views: dict[str, DataFrame], paths: Paths, options: JobOptions = JobOptions()
) -> dict[str, int]:
    """CSV summaries, dashboard JSON and chart tables; returns how many summaries and charts are stored with data files.

    The writes are small and independent, so a few run side by side.
    """
    spec = options.spec
    writes = []
    for name, view in views.items():
        files = 1 if name in v.BOUNDED_VIEWS else options.group_view_files
        writes.append(partial(write_view_csv, view, paths.summary(name), files))
        order = v.view_order(name, spec)
        writes.append(partial(write_dashboard_json, view, order, paths.dashboard(name), single_file=options.single_files))
    charts = chart_tables(views, spec)
    for name, chart in charts.items():
        writes.append(partial(write_chart_table, chart, paths.chart(name)))
    # job group, tags and other local properties of the caller hold for the writes too
    spark = views[v.HOURLY].sparkSession
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(_WRITES_AT_ONCE) as pool:
        running = [pool.submit(inherit(write)) for write in writes]
    for write in running:
        write.result()
    return stored_results(spark, paths)


def stored_results(spark: SparkSession, paths: Paths) -> dict[str, int]:
    """Summaries and charts that are there, by their data files."""
    return {
        "csv_files": sum(has_data(spark, paths.summary(x)) for x in v.VIEWS),
        "visualizations": sum(has_data(spark, paths.chart(x)) for x in CHARTS),
    }


def stored_months(analytical: DataFrame) -> DataFrame:
    """Rows per stored month; reads no column data, as year and month are directory names."""
    return analytical.groupBy("year", "month").agg(F.count(F.lit(1)).alias("records"))


def month_metrics(analytical: DataFrame) -> dict[str, int]:
    """Number of year folders and of month folders. A NULL year is a folder too."""
    months = stored_months(analytical)
    years = F.count_distinct(F.coalesce(F.col("year").cast("string"), F.lit("none")))
    row = months.agg(years.alias("years"), F.count(F.lit(1)).alias("months")).first()
    return {"parquet_partitions": row["years"], "parquet_months": row["months"]}


def counters_of(metrics: dict[str, dict[str, float]]) -> dict[str, int]:
    """The whole numbers that a run has counted, for its line in the log."""
    return {
        f"{stage}.{name}": value
        for stage, values in metrics.items()
        for name, value in values.items()
        if isinstance(value, int)
    }


def commit_run(
    spark: SparkSession, paths: Paths, mode: str, columns: tuple[str, ...], counters: dict[str, int], spec: FeedSpec = DEFAULT
) -> None:
    """Takes the sums by month of a written run and commits it; for runs that publish no results of their own."""
    state = store_state(spark, read_analytical(spark, paths.analytical, spec, columns), paths.state, spec)
    log.commit(spark, paths.root, paths.run, mode, months_of(state), columns, counters)


def publish(spark: SparkSession, paths: Paths) -> None:
    """Moves the results of a committed run from where they were staged to their stated names."""
    staged = paths.staged()
    for source, target in zip([staged.landed, *staged.results()], [paths.landed, *paths.results()], strict=True):
        if exists(spark, source):
            move(spark, source, target)
    log.remove(spark, staged.out)


def run_job(
    spark: SparkSession, source: str, output: str, options: JobOptions = JobOptions()
) -> JobResult:
    """All stages. A failure writes the report so far under another name and is returned.

    The caller owns the session.
    """
    paths, quality = Paths(output.rstrip("/"), log.new_run()), QualityMetrics()
    staged, committed = paths.staged(), False
    feed = _Source(spark, source, options)
    try:
        if options.mode not in log.MODES:
            raise ValueError(f"mode is one of {', '.join(log.MODES)}, not {options.mode!r}")
        if options.quarantine and (options.land or options.limit is not None):
            raise ValueError("rejected rows can be kept only from the feed itself: leave out land and limit")
        feed = feed.with_known_fields()
        options = feed.options
        feed.check_columns()
        own = replace(options, mode="overwrite")  # the run's folder is its own
        if options.land:
            ingest(spark, source, staged.landed, options, quality)
            raw = read_feed(spark, staged.landed, "json", options.spec, options.fields)
            size = stored_bytes(spark, staged.landed)
            landed = replace(feed, path=staged.landed, options=replace(options, source_format="json"))
            columns = transform(raw, paths.analytical, own, quality, source_bytes=size, pieces=landed.pieces(size))
        elif options.limit is not None:
            rows, metrics = feed.first_rows(options.limit)
            quality.add_metrics("extraction", metrics)
            columns = transform(rows, paths.analytical, own, quality)
        else:
            size = stored_bytes(spark, source)
            columns = transform(feed.raw(), paths.analytical, own, quality, True, size, feed.pieces(size))
            quality.add_metric("extraction", "file_size_mb", round(size / 1024 / 1024, 2))
        for result in paths.results():  # what stands in their way is an error before anything is replaced
            make_folder(spark, result.rpartition("/")[0])
        table = read_analytical(spark, paths.analytical, options.spec, columns)
        state = store_state(spark, table, paths.state, options.spec)
        done = log.read_log(spark, paths.root)
        this = log.Commit(len(done) + 1, paths.run, options.mode, frozenset(months_of(state)), columns, counters_of(quality.metrics))
        if options.mode != log.OVERWRITE:
            state = log.read_runs(spark, paths.root, "state", v.state_schema(options.spec), [*done, this])
        written = persist_views(summarise(spark, state, staged.view_summary, options.spec), staged, options)
        months = set().union(*log.live([*done, this]).values())
        quality.add_metrics("persistence", {"parquet_partitions": len({y for y, _ in months}), "parquet_months": len(months), **written})
        quality.save_table(spark, staged.quality_table)
        quality.save_report(spark, staged.report(), options.single_files)
        log.commit(spark, paths.root, this.run, this.mode, set(this.months), columns, this.counters)
        committed = True
        publish(spark, paths)
        if options.keep_runs is not None:
            log.drop_old_runs(spark, paths.root, options.keep_runs)
        return JobResult(True, paths, quality)
    except Exception as error:
        try:
            if not committed:
                log.drop_run(spark, paths.root, paths.run)
            quality.save_report(spark, paths.report(failed=True), options.single_files)
        except Exception:  # the first error is the one to return
            pass
        return JobResult(False, paths, quality, error)
