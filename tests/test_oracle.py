"""Every registered query with SQL gives the SQL's rows on the smallest tables."""

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SLOW = {"mf_train", "deep_train", "residual_train", "autorec_train"}  # covered by test_training


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [q for q in queries() if q not in SLOW])
def test_query_matches_sql(spark, con, sf_dir, name):
    result = compare(spark, con, name, queries()[name], oracle_sql().get(name), sf_dir)
    assert not result.startswith("FAIL"), result


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    result = entry(spark)
    assert result.columns == ["user_id", "item_id", "prediction"]
    assert result.count() > 0
