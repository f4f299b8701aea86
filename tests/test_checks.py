"""Every check query against its SQL twin in DuckDB, on the smallest test tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

import checks  # noqa: E402
from compare import TABLES, bag  # noqa: E402

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(checks.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = checks.QUERIES[name](spark, SF_DIR)
    result = duck.sql(checks.ORACLES[name])
    assert sorted(df.columns) == sorted(result.columns)
    assert bag(df.columns, df.collect()) == bag(result.columns, result.fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
