"""The ingest row limit, without sending the feed through one task.

``DataFrame.limit`` in front of a write cuts each task to ``n`` rows, shuffles what is left
to a single task and takes ``n`` there. A task holds fewer rows than a usual ``n``, so the
whole feed would be read and shuffled. Here files are counted a few at a time, in name order,
until they hold enough rows. Files before the cut are read whole, by a condition on the file name.
The file at the cut is counted by block, the pieces in which Spark reads it: blocks before the cut are
taken whole, and only rows of the one block at the cut pass through a limit.

What was counted can be kept in an index (``KeptIndex``), a table of counts by file and, for files that were cut, by block.
Later limited runs look files up there and parse only those that are new or have changed, besides the rows that
they take.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from threadsift.operators.clean import INGEST_RULES, REJECT
from threadsift.operators.quality import ROWS_READ, reject_counts
from threadsift.sources.files import exists
from threadsift.sources.readers import as_path
from threadsift.sources.scratch import scratch_folder

# Files counted per step: 1, 4, 16, ... up to this many, which bounds each result fetched.
_MOST_FILES_PER_STEP = 4096
_FILE, _BLOCK = "_metadata.file_path", "_metadata.file_block_start"
_COUNTERS = (ROWS_READ, *INGEST_RULES)
_KEY = ("file", "length", "modified")
_NO_ROWS = dict.fromkeys(("kept", *_COUNTERS), 0)
# The pieces of a file may change between two reads when the cluster grows or shrinks.
_ATTEMPTS = 3


@dataclass(frozen=True)
class Cut:
    """The last file read whole (and all before it in name order), the file cut and the rows to take
    from it, and of all of them the counters and bytes."""

    last_whole: str | None
    cut: str | None
    rows_of_cut: int
    counts: dict[str, int]
    bytes: int
    listed: Row | None = None  # the file cut, as it was listed


class KeptIndex:
    """Rows kept and dropped per file and block, stored at ``path``.

    An entry holds for a file of that name, length and time of modification. Entries without a block are for whole files. Blocks depend on the
    session's settings, so what is taken by them is checked by its number of rows.
    """

    SCHEMA = "file string, length long, modified timestamp, block long, kept long, " + ", ".join(f"{c} long" for c in _COUNTERS)

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.SCHEMA)
        stored = self.spark.read.schema(self.SCHEMA).parquet(self.path)
        # two runs at a time may have counted the same file
        return stored.groupBy(*_KEY, "block").agg(*[F.max(c).alias(c) for c in ("kept", *_COUNTERS)])

    def files(self) -> DataFrame:
        return self.entries().filter("block is null").drop("block")

    def blocks(self, file: Row) -> list[tuple[int, int]]:
        same = [F.col(c) == F.lit(file[c]) for c in _KEY]
        rows = self.entries().filter(same[0] & same[1] & same[2] & F.col("block").isNotNull()).select("block", "kept").collect()
        return sorted((r["block"], r["kept"]) for r in rows)

    def add(self, rows: list[tuple]) -> None:
        if rows:
            self.spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


def _listing(files: DataFrame, index: KeptIndex | None) -> DataFrame:
    """Files in name order with their counts where the index has them, written once for all steps."""
    if index is None:
        known = files.select("*", *[F.lit(None).cast("long").alias(c) for c in ("kept", *_COUNTERS)])
    else:
        known = files.join(index.files(), list(_KEY), "left")
    path = scratch_folder(files.sparkSession, "listing")
    known.orderBy("file").write.parquet(path)
    return files.sparkSession.read.schema(known.schema).parquet(path)


def find_cut(
    read_tagged: Callable[[list[str]], DataFrame], files: DataFrame, rows: int, index: KeptIndex | None = None
) -> Cut:
    """Where the first ``rows`` kept rows end, over ``files`` (file, length, modified) in name order."""
    if rows <= 0:
        raise ValueError("the row limit must be positive; leave it out to read everything")
    files = _listing(files, index)
    counts = dict.fromkeys(_COUNTERS, 0)
    last, left, step, size, new = None, rows, 1, 0, []
    found: Cut | None = None
    while found is None:
        waiting = files if last is None else files.filter(F.col("file") > last)
        batch = waiting.orderBy("file").limit(step).collect()
        if not batch:
            found = Cut(last, None, 0, counts, size)
        counted = _count([f for f in batch if f["kept"] is None], read_tagged)
        rows_of = {f["file"]: f.asDict() if f["kept"] is not None else counted.get(f["file"], _NO_ROWS) for f in batch}
        for f in batch:
            if f["kept"] is None:
                new.append((*[f[c] for c in _KEY], None, *[rows_of[f["file"]][c] for c in _NO_ROWS]))
        for f in batch:
            row = rows_of[f["file"]]
            size += f["length"]
            for name in _COUNTERS:
                counts[name] += row[name]
            if row["kept"] > left:
                found = Cut(last, f["file"], left, counts, size, f)
                break
            left -= row["kept"]
            last = f["file"]
            if left == 0:
                found = Cut(last, None, 0, counts, size)
                break
        step = min(4 * step, _MOST_FILES_PER_STEP)
    if index is not None:
        index.add(new)
    return found


def _count(files: list[Row], read_tagged: Callable[[list[str]], DataFrame]) -> dict[str, dict[str, int]]:
    """Rows kept and dropped of these files; files without rows have no entry."""
    if not files:
        return {}
    per_file = (
        read_tagged([as_path(f["file"]) for f in files])
        .groupBy(F.col(_FILE).alias("file"))
        .agg(F.count_if(F.col(REJECT).isNull()).alias("kept"), *reject_counts(INGEST_RULES))
    )
    found = {r["file"]: r.asDict() for r in per_file.collect()}
    unknown = found.keys() - {f["file"] for f in files}
    if unknown:
        raise RuntimeError(f"rows from files that were not asked for: {sorted(unknown)[:3]}")
    return found


def read_to_cut(
    spark: SparkSession,
    read_kept: Callable[[list[str] | None, Column | None], DataFrame],
    cut: Cut,
    index: KeptIndex | None = None,
) -> DataFrame | None:
    """The rows up to the cut; None when there is no file.

    ``read_kept`` reads the feed, or only some paths of it, under a condition.
    """
    whole = read_kept(None, F.col(_FILE) <= cut.last_whole) if cut.last_whole is not None else None
    rest = None if cut.cut is None else _first_of_file(spark, read_kept, cut, index)
    if whole is None or rest is None:
        return rest if whole is None else whole
    return whole.unionByName(rest)


def _first_of_file(spark: SparkSession, read_kept, cut: Cut, index: KeptIndex | None) -> DataFrame:
    """The first rows of one file, written: which rows a limit takes may change when its task runs
    again after a loss. The file is read alone each time, so its blocks are the same."""
    file, rows = [as_path(cut.cut)], cut.rows_of_cut
    known = index.blocks(cut.listed) if index is not None and cut.listed is not None else []
    for attempt in range(_ATTEMPTS):
        per_block = known if known and not attempt else sorted(tuple(r) for r in _with_block(read_kept, file).groupBy("_block").count().collect())
        sums = list(accumulate(n for _, n in per_block))
        at = next((i for i, n in enumerate(sums) if n >= rows), None)
        if at is None:
            continue
        block, before = per_block[at][0], sums[at] - per_block[at][1]
        head = read_kept(file, F.col(_BLOCK) < block)
        taken = head.unionByName(read_kept(file, F.col(_BLOCK) == block).limit(rows - before))
        path = scratch_folder(spark, "cut")
        taken.write.parquet(path)
        staged = spark.read.schema(taken.schema).parquet(path)
        if staged.count() == rows:
            if index is not None and cut.listed is not None and per_block != known and not known:
                index.add([(*[cut.listed[c] for c in _KEY], b, n, *[None] * len(_COUNTERS)) for b, n in per_block])
            return staged
    raise RuntimeError(f"the blocks of {file[0]} keep changing")


def _with_block(read_kept, file: list[str]) -> DataFrame:
    return read_kept(file, None, with_block=True)
