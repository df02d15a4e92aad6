"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import connect, difference, from_duck, from_spark

CHECKED = sorted(oracle_sql())
UNCHECKED = sorted(set(queries()) - set(oracle_sql()))


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, sf, con, name):
    df = queries()[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # no query pairs all rows with all rows
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    got = from_spark(df)
    assert difference(got, from_duck(con, oracle_sql()[name])) is None


@pytest.mark.parametrize("name", UNCHECKED)
def test_query_without_sql_gives_rows(spark, sf, name):
    assert queries()[name](spark, sf).count() > 0


def test_entry_runs(spark):
    assert entry(spark).count() == 8
