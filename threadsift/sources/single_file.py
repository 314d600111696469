"""A Spark data source that writes a bounded result as one file of the stated name.

Tasks send their lines with their commit messages; the driver's commit writes them beside the target and renames, so the file is
there whole or not at all, and what a failed write leaves behind is the file of before. For results of a known, small size,
such as a dashboard's rows or a report: beyond ``MOST_BYTES`` the write fails. The path is one that pyarrow can open (local, shared mount,
S3, GCS, HDFS with its client).
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "threadsift_single_file"
MOST_BYTES = 64 << 20


@dataclass
class _Lines(WriterCommitMessage):
    lines: list[str]


def _place(path: str):
    """The file system of a path, and the path within it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        system, inside = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        return system, inside
    return fs.LocalFileSystem(), path


class _Writer(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        lines, size = [], 0
        for row in iterator:
            lines.append(row[0] or "")
            size += len(lines[-1])
            if size > MOST_BYTES:
                raise ValueError(f"more than {MOST_BYTES} characters for one file")
        return _Lines(lines)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, path = _place(self.path)
        found = system.get_file_info(path)
        if found.type != fs.FileType.NotFound and not self.overwrite:
            raise FileExistsError(self.path)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        beside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}.part"
        try:
            with system.open_output_stream(beside) as out:
                for message in messages:
                    for line in message.lines if message else ():
                        out.write(f"{line}\n".encode())
            if found.type == fs.FileType.Directory:  # an earlier result that was written as a folder
                system.delete_dir(path)
            system.move(beside, path)
        except BaseException:
            if system.get_file_info(beside).type != fs.FileType.NotFound:
                system.delete_file(beside)
            raise

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Nothing to undo: before the commit there is no file."""


class SingleFile(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if [f.dataType.simpleString() for f in schema.fields] != ["string"]:
            raise ValueError("one text column makes a file")
        return _Writer(self.options["path"], overwrite)


def write_single_file(spark: SparkSession, text: DataFrame, path: str) -> None:
    """The rows of a bounded one-column table as the lines of one file, in place of what is there."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package
    spark.dataSource.register(SingleFile)
    spark._jvm.SparkSession.setActiveSession(spark._jsparkSession)  # a source is looked up in the session of the thread
    text.write.format(NAME).mode("overwrite").save(path)
