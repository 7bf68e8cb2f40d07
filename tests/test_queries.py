"""Every registered query against its SQL on the smallest tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from beaconlake.plans.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
# Queries without SQL.
ROWS_ONLY: set[str] = set()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the given tables are not there")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return None if isinstance(value, float) and math.isnan(value) else float(value)
    return str(value)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, database, name):
    found = contract.queries()[name](spark, str(DATA))
    columns = sorted(found.columns)
    rows = Counter(tuple(_plain(v) for v in r) for r in found.select(*[f"`{c}`" for c in columns]).collect())
    if name in ROWS_ONLY:
        assert rows
        return
    cursor = database.execute(contract.oracle_sql()[name])
    theirs = [d[0] for d in cursor.description]
    assert sorted(theirs) == columns
    order = [theirs.index(c) for c in columns]
    assert rows == Counter(tuple(_plain(r[i]) for i in order) for r in cursor.fetchall())


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert (set(contract.oracle_sql()) | ROWS_ONLY) & set(QUERIES) == set(QUERIES)


def test_entry(spark):
    found = contract.entry(spark)
    assert 0 < found.count() <= 100 and len(found.columns) == 18


def test_no_plan_has_a_cross_join(spark):
    for name in ["known_destination", "service_dependencies", "metric_iqm", "accept_pages_seen", "put_status", "auto_create"]:
        plan = contract.queries()[name](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
