"""The registered queries against their SQL."""

import duckdb
import pytest

from threadsift.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(ORACLE[name])
    columns = sorted(want.columns)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted(map(repr, (tuple(r) for r in got.select(columns).collect()))) == sorted(map(repr, want.select(*columns).fetchall()))


def test_all_are_registered():
    assert len(QUERIES) == 13
