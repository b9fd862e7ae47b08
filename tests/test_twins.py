"""Every query against its SQL twin, over whole tables."""

import duckdb
import pytest

import __spark_entry__ as contract
import suite
from conftest import SMALL
from suite.check import connect, same

QUERIES, TWINS = suite.queries(), suite.oracle_sql()
# What depends on the clock or on chance has no twin.
NO_TWIN = {"s15_sample", "q11_recency"}


@pytest.fixture(scope="module")
def con():
    with duckdb.connect() as c:
        yield connect(SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    if name in TWINS:
        assert same(df, con.sql(TWINS[name])) == ""
    else:
        assert df.count() > 0


def test_only_chance_and_clock_lack_a_twin():
    assert set(QUERIES) - set(TWINS) == NO_TWIN


def test_the_contract_has_them_all():
    assert set(QUERIES) <= set(contract.queries()) and set(TWINS) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
