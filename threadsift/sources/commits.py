"""Which runs make up a table: a log to which every finished run adds one line, as the last thing it does.

A run writes folders of its own, ``analytical/run=<run>/reject=kept`` (and beside it what it has rejected, if that is
to stay) and ``state/run=<run>``, and becomes part of the table with its
line in ``manifest``. Until then readers, who go through the log, see the runs before it; what a failed run has
written is never read. A line says whether the run replaces everything, adds to it, or replaces the months that it has, and
holds the run's counters, so these survive the driver. A line is one file that appears at once, by the rename at
the end of Spark's write. Lines with one version, from two writers at a time, count in the order of their runs.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadsift.operators.quality import one_row
from threadsift.sources.files import exists, names, remove

OVERWRITE, APPEND, OVERWRITE_MONTHS = "overwrite", "append", "overwrite_months"
MODES = (OVERWRITE, APPEND, OVERWRITE_MONTHS)
RUN = "run"
PARTS = ("analytical", "state")
KEPT_FOLDER = "reject=kept"
_LINE = "version long, run string, mode string, months array<struct<year int, month int>>, columns array<string>, counters map<string, long>"

Month = tuple[int | None, int | None]


@dataclass(frozen=True)
class Commit:
    version: int
    run: str
    mode: str
    months: frozenset[Month]
    columns: tuple[str, ...]
    counters: dict[str, int]


def new_run() -> str:
    return uuid.uuid4().hex


def run_folder(root: str, part: str, run: str) -> str:
    return f"{root}/{part}/{RUN}={run}"


def log_table(spark: SparkSession, root: str) -> DataFrame:
    """The lines of the log as they are stored."""
    path = f"{root}/manifest"
    return spark.read.schema(_LINE).json(path) if exists(spark, path) else spark.createDataFrame([], _LINE)


def read_log(spark: SparkSession, root: str) -> list[Commit]:
    """All commits in their order, a line for each run."""
    lines = log_table(spark, root).orderBy("version", "run").collect()
    return [
        Commit(r["version"], r["run"], r["mode"], frozenset((m["year"], m["month"]) for m in r["months"]), tuple(r["columns"]), dict(r["counters"]))
        for r in lines
    ]


def commit(
    spark: SparkSession, root: str, run: str, mode: str, months: set[Month], columns: tuple[str, ...], counters: dict[str, int]
) -> None:
    """Makes ``run`` part of the table. The folder has one writer at a time."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}, not {mode!r}")
    log = read_log(spark, root)
    line = {
        "version": max((c.version for c in log), default=0) + 1, "run": run, "mode": mode,
        "months": [{"year": y, "month": m} for y, m in sorted(months, key=repr)], "columns": list(columns), "counters": counters,
    }
    one_row(spark).select(F.lit(json.dumps(line)).alias("value")).write.mode("append").text(f"{root}/manifest")


def live(log: list[Commit]) -> dict[str, set[Month]]:
    """The runs that make up the table, each with the months that count."""
    found: dict[str, set[Month]] = {}
    for c in log:
        if c.mode == OVERWRITE:
            found = {}
        elif c.mode == OVERWRITE_MONTHS:
            found = {run: months - c.months for run, months in found.items()}
            found = {run: months for run, months in found.items() if months}
        found[c.run] = set(c.months)
    return found


def _month_key(run: Column, year: Column, month: Column) -> Column:
    return F.concat_ws("/", run, F.coalesce(year.cast("string"), F.lit("-")), F.coalesce(month.cast("string"), F.lit("-")))


def read_runs(spark: SparkSession, root: str, part: str, schema: T.StructType, log: list[Commit]) -> DataFrame:
    """One part of all live runs, of each only the months that count; for the table both choose folders by their names."""
    counted = live(log)
    if not counted:
        return spark.createDataFrame([], schema)
    with_run = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])
    folders = [run_folder(root, part, r) + (f"/{KEPT_FOLDER}" if part == "analytical" else "") for r in counted]
    rows = spark.read.schema(with_run).option("basePath", f"{root}/{part}").parquet(*folders)
    dead = [(c.run, y, m) for c in log if c.run in counted for y, m in c.months - counted[c.run]]
    if dead:
        text = ["/".join((r, "-" if y is None else str(y), "-" if m is None else str(m))) for r, y, m in sorted(dead, key=repr)]
        rows = rows.filter(~_month_key(F.col(RUN), F.col("year"), F.col("month")).isin(text))
    return rows.select(*schema.names)


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """(run, reject, record): what the live runs have rejected and kept aside. Folders of kept rows are not read."""
    kind = T.StructType([T.StructField(c, T.StringType()) for c in ("record", RUN, "reject")])
    folders = [run_folder(root, "analytical", r) for r in live(read_log(spark, root))]
    if not folders:
        return spark.createDataFrame([], kind).select(RUN, "reject", "record")
    rows = spark.read.schema(kind).option("basePath", f"{root}/analytical").parquet(*folders)
    return rows.filter(F.col("reject") != "kept").select(RUN, "reject", "record")


def drop_run(spark: SparkSession, root: str, run: str) -> None:
    """Removes what a run has written, other than its line in the log."""
    for part in (*PARTS, "staged"):
        remove(spark, run_folder(root, part, run))


def drop_old_runs(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Removes committed runs of which nothing counts any more, but for the last ``keep`` of them, which readers may still read."""
    log = read_log(spark, root)
    counted = live(log)
    old = [c.run for c in log if c.run not in counted]
    stored = set(names(spark, f"{root}/analytical"))
    gone = [r for r in dict.fromkeys(old[: len(old) - keep] if keep else old) if f"{RUN}={r}" in stored]
    for run in gone:
        drop_run(spark, root, run)
    return gone


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """(version, run, counter, value): what every committed run has counted."""
    return log_table(spark, root).select("version", "run", F.explode("counters").alias("counter", "value"))
