"""Every registered query equals its SQL, in two time zones."""

import pytest

import __spark_entry__ as contract
from conftest import SMALL
from threadsift.operators.features import analytical_table
from threadsift.operators.views import sentiment_distribution
from tools.compare import compare, oracle_connection
from workload.feed import comment_feed
from workload.oracle import ORACLE
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SMALL)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys() and ORACLE.keys() <= contract.oracle_sql().keys()


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.count() == 21 and rows.columns[0] == "subreddit"


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name, zone):
    ok, note = compare(spark, con, name, SMALL)
    assert ok, note


@pytest.mark.parametrize(
    ("sf", "raw", "kept", "months", "classes"),
    [("0.001", 200, 177, 67, (56, 46, 75)), ("0.01", 1000, 875, 80, (269, 249, 357))],
)
def test_known_numbers_of_the_feed(spark, sf, raw, kept, months, classes):
    feed = comment_feed(spark, f"/root/testdata/sf{sf}")
    table = analytical_table(feed).cache()
    assert (feed.count(), table.count()) == (raw, kept)
    assert table.select("year", "month").distinct().count() == months
    counts = {r["sentiment_proxy"]: r["count"] for r in sentiment_distribution(table).collect()}
    assert tuple(counts[k] for k in ("negative", "neutral", "positive")) == classes
    assert table.select("hour").distinct().count() == 24
    assert table.select("subreddit").distinct().count() == 21
    table.unpersist()
