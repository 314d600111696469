"""Readers with explicit schemas: no inference pass, no surprise types."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadsift.spec import CORRUPT, DEFAULT, FeedSpec


DETECT = "detect"


def detect_fields(spark: SparkSession, path: str | list[str], spec: FeedSpec = DEFAULT) -> tuple[str, ...]:
    """The feed's fields that occur in its JSON Lines: one full pass over them."""
    found = spark.read.option("primitivesAsString", "true").json(path).columns
    return tuple(f for f in spec.fields if f in found)


def read_feed(
    spark: SparkSession,
    path: str | list[str],
    format: str = "json",
    spec: FeedSpec = DEFAULT,
    fields: tuple[str, ...] | None = None,
) -> DataFrame:
    """The raw feed from landed files.

    JSON Lines are read with every field as text and a malformed line as a row with only
    ``_corrupt_record`` set. Parquet keeps its own types; conversions come later.
    ``fields`` names the fields a JSON feed carries (all eight unless given).
    """
    if format == "json":
        return (
            spark.read.schema(spec.raw_schema(fields))
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .json(path)
        )
    if format == "parquet":
        paths = [path] if isinstance(path, str) else path
        return spark.read.parquet(*paths)
    raise ValueError(f"format is 'json' or 'parquet', not {format!r}")


def read_analytical(
    spark: SparkSession, path: str, spec: FeedSpec = DEFAULT, columns: tuple[str, ...] | None = None
) -> DataFrame:
    """The analytical table, columns in their defined order.

    Filters on ``year`` and ``month`` prune directories. With the schema given, a table
    without rows reads back as an empty table. ``columns`` names the columns written when
    the feed lacked some.
    """
    schema = spec.analytical_schema(columns)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


# A summary has nothing where a key is NULL and "" where it is empty. The default reader
# takes both for NULL; with a null marker that no key holds it tells them apart.
_NO_KEY = "\x00null\x00"


def read_view_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A summary written by ``write_view_csv``; NULL and empty text stay apart."""
    return spark.read.schema(schema).csv(path, header=True, nullValue=_NO_KEY, emptyValue="")


def read_dashboard_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A dashboard file: one JSON array of at most a few dozen rows."""
    return spark.read.schema(schema).json(path, multiLine=True)


def stored_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, length, modified) of the files that a feed reader reads at ``path``, from the file listing alone.

    Nested folders count only where they are partitions, as for the readers. The binary source
    opens a file only when its content is asked for.
    """
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("_metadata.file_path").alias("file"), "length", F.col("modificationTime").alias("modified"))


def stored_bytes(spark: SparkSession, path: str | list[str]) -> int:
    """Bytes of the files that a feed reader reads at ``path``."""
    return stored_files(spark, path).groupBy().sum("length").first()[0] or 0


def as_path(uri: str) -> str:
    """A name to read back: not URL-encoded, and its pattern characters taken literally."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the files below a DataFrame, None where it reads none."""
    files = df.inputFiles()
    return stored_bytes(df.sparkSession, list(map(as_path, files))) if files else None
