"""Every registered query beside its SQL text, and the driver contract."""

import pytest
from oracle import connect, differences

import __spark_entry__ as contract

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_is_the_bad_rate_curve(spark, sf_dir):
    df = contract.entry(spark)
    assert df.columns == ["mob", "bad_rate", "n_rows"]
    assert df.count() == 11
