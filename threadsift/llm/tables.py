"""Tables in and between the steps of an operator."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift.sources.scratch import scratch_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Later steps read files, so a lost executor costs them no recomputation, and what a step
    decided stays decided.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows and bytes in an Arrow batch.
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the Python workers, which may not have it installed, and bounds what passes to them
    at a time: ten thousand long texts, the default, take some hundred MB in the executor and as much in its worker."""
    for key, value in ARROW_BATCH.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="threadsift-")) / "threadsift_workers.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


#: Rows, and members of their arrays, that a side may have to be sent to every task: some 30 MB each.
BROADCAST_ROWS = 400_000
BROADCAST_ENTRIES = 1_000_000


def small_side(df: DataFrame, entries: Column | None = None) -> DataFrame:
    """``df`` marked for broadcast if it was counted to be small, else as it is, for a shuffled join. ``entries`` is the
    number of members in the arrays of a row."""
    n = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.lit(0) if entries is None else entries), F.lit(0)).alias("entries")).first()
    return F.broadcast(df) if n["rows"] <= BROADCAST_ROWS and n["entries"] <= BROADCAST_ENTRIES else df
