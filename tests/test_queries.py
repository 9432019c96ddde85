"""Every registered query against its SQL counterpart on the smallest sample."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tenderlake.catalog.queries import QUERIES
from compare import database, differences, type_differences

SF_DIR = "/root/testdata/sf0.001"
ROWS_ONLY = {"forecast", "backtest_model", "isolation_score", "score_job"}


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_an_oracle_unless_it_fits_a_model():
    assert set(QUERIES) - set(oracle_sql()) == ROWS_ONLY
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if name in oracle_sql():
        assert differences(rows, df.columns, con, oracle_sql()[name]) is None
        assert type_differences(df, con, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
