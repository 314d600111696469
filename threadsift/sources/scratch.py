"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared folder ``spark.checkpoint.dir``.

    A machine-local folder serves only a local master, where all tasks share one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="threadsift-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
