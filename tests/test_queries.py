"""Every named query on the smallest tables, against its check SQL where there is one."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
ORACLES = oracle_sql()
# Too few rows at this scale for these filters to match any.
MAY_BE_EMPTY = {"second_longest_p90", "top_pickup_zones", "largest_tip", "count_on_day", "partition_pruned_distinct"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, name):
    _, problems = compare(spark, con, queries()[name], ORACLES[name], SF)
    assert [p for p in problems if not (p == "no rows" and name in MAY_BE_EMPTY)] == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(ORACLES)))
def test_runs(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(queries())
