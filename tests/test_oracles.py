"""Every registered query against its SQL in DuckDB, on the smallest test tables."""

from __future__ import annotations

import pytest

import check_oracles
from __spark_entry__ import entry, oracle_sql, queries
from martflow.plans.queries import QUERIES
from martflow.plans.registry import _parts
from tests.conftest import SF_SMALL

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not SF_SMALL.exists(), reason="test tables are not here")
ORACLES = {name: sql for name, sql in oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in check_oracles.TABLES:
        connection.execute(f"create view {table} as select * from '{SF_SMALL}/{table}.parquet'")
    yield connection
    connection.close()


def test_every_query_of_the_marts_has_an_oracle():
    assert set(ORACLES) == set(QUERIES) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, str(SF_SMALL))
    rows = [tuple(r) for r in df.collect()]
    # An unrounded double would depend on the order of addition.
    kinds = dict(_parts(QUERIES[name].columns))
    assert not [c for c, t in df.dtypes if t == "double" and not kinds[c].isdigit()]
    result = duck.execute(ORACLES[name])
    assert check_oracles.compare(rows, df.columns, result.fetchall(), [c[0] for c in result.description]) == "ok"
