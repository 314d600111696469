import contextlib
import io
import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(base / "shared"))
        .config("spark.local.dir", str(base / "local"))
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    """Runs a test under two session time zones; results may not differ."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.fixture
def feed(spark):
    """Builds a raw feed from rows given as dicts; a field left out is NULL."""
    from threadsift.spec import DEFAULT

    def build(*rows, fields=DEFAULT.fields):
        schema = ", ".join(f"{f} string" for f in fields)
        base = {"body": "some text", "score": "1", "created_utc": "1325376000", "subreddit": "g"}
        values = []
        for i, row in enumerate(rows):
            full = {**base, "id": f"r{i}", **row}
            values.append(tuple(full.get(f) for f in fields))
        return spark.createDataFrame(values, schema)

    return build


def plan_of(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
