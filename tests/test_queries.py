"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import compare, duck
from sparge.registry.oracles import all_oracles
from sparge.registry.queries import all_queries

QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, folder, name):
    result = compare(spark, con, folder, QUERIES[name], ORACLES[name])
    assert result["same"], result


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["beer_style", "review_year", "review_month", "total_reviews", "avg_rating"]
    assert df.count() > 0
