"""Folders seen through the file system that Spark itself writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def make_folder(spark: SparkSession, path: str) -> None:
    """Fails where something other than a folder is in the way."""
    system, place = _at(spark, path)
    system.mkdirs(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly below a folder; nothing where there is none."""
    system, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a sink holds a data file: a writer's parts, or the file itself."""
    system, place = _at(spark, path)
    if not system.exists(place):
        return False
    found = [system.getFileStatus(place)] if not system.getFileStatus(place).isDirectory() else list(system.listStatus(place))
    return any(s.isDirectory() or not s.getPath().getName().startswith(("_", ".")) for s in found)


def remove(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.delete(place, True)


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Moves a finished folder or file to ``target`` in place of what is there. Nothing is copied."""
    system, place = _at(spark, source)
    _, end = _at(spark, target)
    make_folder(spark, target.rpartition("/")[0])
    system.delete(end, True)
    if not system.rename(place, end):
        raise OSError(f"{source} could not be moved to {target}")
