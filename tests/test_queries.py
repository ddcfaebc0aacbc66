"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402
from quayside.plans.registry import ORACLES, QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in check.TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert check.rows(got) == check.rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
