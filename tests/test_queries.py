"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as entry_module
from retail_lake.plans.oracle import ORACLES
from retail_lake.plans.registry import QUERIES
from tests.conftest import CHECKED
from tests.oracle import actual, connect, expected


@pytest.fixture(scope="module")
def con():
    with connect(CHECKED) as connection:
        yield connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry_module.queries()[name](spark, CHECKED)
    assert actual(df) == expected(con, entry_module.oracle_sql()[name])


def test_entry_is_the_flagship_query(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 7  # six categories and the lines whose product was dropped
