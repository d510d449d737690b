"""Every query with a DuckDB twin gives exactly the twin's rows."""

import oracle_check
import pytest

from cardwarden.catalog import all_queries
from cardwarden.fixtures import Inputs
from cardwarden.oracle import all_sql
from cardwarden.plans import profiling

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle_check.connect(sf_dir)


def test_every_statement_belongs_to_a_query():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_twin(spark, duck, sf_dir, name):
    assert oracle_check.difference(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None


def test_approximate_stats(spark, sf_dir):
    approx = profiling.amount_stats(Inputs(spark, sf_dir).tx, approximate=True).first()
    exact = QUERIES["amount_stats_exact"](spark, sf_dir).first()
    assert approx["mean_amount"] == exact["mean_amount"]
    assert abs(approx["median_amount"] - exact["median_amount"]) < 0.5


def test_entry(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark)
    assert rows.count() == 15
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
