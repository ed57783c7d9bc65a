"""Every registered query against its oracle, on the smallest tables."""

import pytest

import __spark_entry__ as registered
from oracle_check import connect, differences, is_ordered, out_of_order
from vintagemart.plans.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db(small):
    with connect(small) as connection:
        yield connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= registered.queries().keys()


def test_entry_is_the_label_store(spark):
    assert registered.entry(spark).columns == ["loan_id", "Customer_ID", "label", "label_def", "snapshot_date"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, small, db, name):
    df = registered.queries()[name](spark, small)
    sql = registered.oracle_sql()[name]
    assert differences(df, db, sql) == []
    if is_ordered(df):
        assert out_of_order(df, db, sql) == []
