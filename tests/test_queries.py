"""Every registered query with an oracle equals it on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SLOW = {"boosted_metrics", "forest_cross_validation", "boosted_cross_validation", "supervised_run"}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SLOW])
def test_equals_oracle(spark, sf_dir, duck, name):
    problem = compare(spark, duck, name, entry.queries()[name], SQL.get(name), sf_dir)
    # The smallest tables may leave an oracle empty; both sides are then empty.
    assert problem in (None, "oracle gives no rows"), problem


def test_every_oracle_has_its_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 100
