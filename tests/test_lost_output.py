"""Counters and rows stay exact when shuffle output is lost while the table is written."""

import glob
import os
import threading
import time

import pytest
from pyspark.sql import Observation

from threadsift.operators.quality import transformation_metrics
from threadsift.operators.table import counted_table
from threadsift.sources.readers import read_analytical, read_feed
from threadsift.sources.writers import write_analytical, write_feed_json
from threadsift.streaming.ingest import finish, start_analytical, stream_analytical, stream_feed
from workload.feed import comment_feed


@pytest.fixture
def many_small_tasks(spark):
    values = {
        "spark.sql.shuffle.partitions": "150",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def slow():
    """A step that takes its time; made here so that it travels to the workers by value."""

    def slowly(batches):
        for rows in batches:
            time.sleep(0.1)
            yield rows

    return slowly


class ShuffleLoss:
    """Removes two shuffle files as soon as the first file of a table is written, when most of
    the shuffle is still to be read."""

    def __init__(self, spark, table):
        # where the blocks really are: the environment may override spark.local.dir
        self.folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
        self.table, self.lost, self.done = table, [], threading.Event()
        self.older = self.shuffles()
        self.thread = threading.Thread(target=self.watch)

    def shuffles(self):
        return {p for folder in self.folders for p in glob.glob(f"{folder}/**/shuffle_*.data", recursive=True)}

    def watch(self):
        while not self.done.is_set():
            if glob.glob(f"{self.table}/**/part-*.parquet", recursive=True):
                for path in sorted(self.shuffles() - self.older)[:2]:
                    os.remove(path)
                    self.lost.append(path)
                return
            time.sleep(0.002)

    def __enter__(self):
        self.thread.start()
        return self

    def __exit__(self, *_):
        self.done.set()
        self.thread.join()


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "feed")
    write_feed_json(comment_feed(spark, "/root/testdata/sf0.01").repartition(6), path)
    return path


def test_lost_map_output_is_counted_once(spark, source, many_small_tasks, tmp_path):
    table, observation = str(tmp_path / "table"), Observation()
    with ShuffleLoss(spark, table) as loss:
        rows = counted_table(read_feed(spark, source), observation)
        write_analytical(rows.mapInPandas(slow(), rows.schema), table)  # so that files go while others wait
    counts = transformation_metrics(observation.get)
    assert (counts["initial_records"], counts["final_records"]) == (1000, 875)
    assert read_analytical(spark, table).count() == 875
    assert loss.lost


def test_stream_counts_lost_map_output_once(spark, source, many_small_tasks, tmp_path):
    table = str(tmp_path / "table")
    stream = stream_analytical(stream_feed(spark, source), drop_empty=False)
    stream = stream.mapInPandas(slow(), stream.schema)
    with ShuffleLoss(spark, table) as loss:
        counts = finish(start_analytical(stream, table, str(tmp_path / "checkpoint")))
    assert (counts["rows_read"], transformation_metrics(counts)["final_records"]) == (1000, 875)
    assert read_analytical(spark, table).count() == 875
    assert loss.lost
