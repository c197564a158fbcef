"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from check import compare, database

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()
# These have tests of their own.
LLM = set(entry_point._training_data()[0])


@pytest.fixture(scope="module")
def con(folder):
    return database(folder)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LLM))
def test_query(spark, con, folder, name):
    result, _ = compare(spark, con, name, folder)
    assert result.startswith(("ok", "rows-only")), result


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["segment", "hh_id", "spend_cents", "propensity"]
    assert df.count() > 0
