"""Every registered query against its reference SQL on DuckDB (sf0.001)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check_oracles import duck_connection, normalized
from conftest import SMOKE_DIR
from test_plans import FORBIDDEN
from tidepool.plans import queries as library

QUERIES = library.QUERIES  # the corpus queries have tests of their own
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SMOKE_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES) and set(QUERIES) <= set(entry.queries())


def test_entry_returns_mart(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "customer_id" and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMOKE_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan]
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert normalized(df.columns, rows) == normalized(ocols, res.fetchall())
