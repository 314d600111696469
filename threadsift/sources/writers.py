"""Writers. Only bounded results are ever brought to one file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadsift.functions import json_double
from threadsift.operators.layout import MONTH_KEY
from threadsift.operators.views import DASHBOARD_ROWS, GROUPED_BY
from threadsift.sources.single_file import write_single_file

OVERWRITE_MONTHS = "overwrite_months"
# Of a clustered table: bytes of text and all in a row group, the unit that a reader skips, before encoding.
ROW_GROUP_BYTES = 8 << 20


def clustered(columns: tuple[str, ...], row_group_bytes: int = ROW_GROUP_BYTES) -> dict[str, str]:
    """Write options for a table whose files are in order: small row groups, and Bloom filters on columns that are looked up
    by value. The filters take the size that their values need."""
    options = {"parquet.block.size": str(row_group_bytes), "parquet.bloom.filter.adaptive.enabled": "true"}
    return options | {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}


def write_feed_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Lands the feed as JSON Lines; a NULL field stays as a key with null."""
    df.write.mode(mode).json(path, ignoreNullFields=False)


def write_analytical(df: DataFrame, path: str, mode: str = "overwrite", options: dict[str, str] | None = None) -> None:
    """Parquet in directories ``year=/month=``.

    ``overwrite`` replaces the table, ``append`` adds files, ``overwrite_months`` replaces
    the months that occur in ``df`` and leaves the rest.
    """
    writer = df.write.partitionBy(*MONTH_KEY).options(**(options or {}))
    if mode == OVERWRITE_MONTHS:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "overwrite":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
    else:
        writer = writer.mode(mode)
    writer.parquet(path)


def write_with_rejects(df: DataFrame, path: str, options: dict[str, str] | None = None) -> None:
    """Kept rows and rejected ones in one write, apart by the reason in the folder name: ``reject=kept/year=/month=`` and the others.

    Replaces what is there, whatever the session's overwrite mode.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**(options or {}))
    writer.partitionBy("reject", *MONTH_KEY).parquet(path)


def write_view_summary(summary: DataFrame, path: str) -> None:
    """The summary behind all views; a view reads only the folder of its own key.

    Replaces what is there whatever the session's overwrite mode, so an empty run leaves no old view.
    """
    writer = summary.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(GROUPED_BY).parquet(path)


def write_view_csv(view: DataFrame, path: str, files: int | None = None) -> None:
    """A summary as CSV with header, in the view's order.

    ``files=1`` is for views of bounded size. Otherwise the sort's own partitions are the
    files, in order by name, and adaptive execution makes that one file for a small view.
    """
    out = view if files is None else view.coalesce(files)
    out.write.mode("overwrite").csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def write_dashboard_json(
    view: DataFrame, order: list[Column], path: str, rows: int = DASHBOARD_ROWS, single_file: bool = False
) -> None:
    """The first rows of a view as one indented JSON array, in a folder or as one file of that name.

    Doubles are rounded to ten decimals and NULL fields keep their key. The limit bounds what
    the array and the numbering see.
    """
    head = view.orderBy(*order).limit(rows)
    doubles = {f.name for f in head.schema.fields if isinstance(f.dataType, T.DoubleType)}
    place = F.row_number().over(W.orderBy(*order))
    record = F.struct(*[json_double(F.col(c)).alias(c) if c in doubles else F.col(c) for c in head.columns])
    placed = head.select(place.alias("place"), record.alias("record"))
    array = F.transform(F.sort_array(F.collect_list(F.struct("place", "record"))), lambda x: x["record"])
    document = placed.agg(F.to_json(array, {"pretty": "true", "ignoreNullFields": "false"}).alias("value"))
    if single_file:
        write_single_file(view.sparkSession, document, path)
    else:
        document.coalesce(1).write.mode("overwrite").text(path)


def write_chart_table(chart: DataFrame, path: str) -> None:
    """A chart's rows, at most a few dozen."""
    chart.coalesce(1).write.mode("overwrite").parquet(path)
