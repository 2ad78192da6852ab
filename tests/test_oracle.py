"""Every registered query with a SQL twin equals DuckDB on the same tables."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.conftest import MEDIUM, SMALL
from tests.oracle_check import compare

SQL = oracle_sql()
FAST = [n for n in SQL if not n.startswith("stream_")]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle_small(spark, duck_small, name):
    info = compare(spark, duck_small, name, queries()[name], SQL[name], SMALL)
    assert info["ok"], info


@pytest.mark.parametrize("name", ["feature_matrix", "walk_forward_folds", "auc_exact",
                                  "parse_events", "latest_closed", "stream_resample",
                                  "stream_features"])
def test_query_matches_oracle_medium(spark, duck_medium, name):
    info = compare(spark, duck_medium, name, queries()[name], SQL[name], MEDIUM)
    assert info["ok"], info
    assert info["rows"] > 0


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() >= 0
    assert "price_to_sma5" in df.columns and "label" in df.columns


def test_every_query_has_unique_name():
    names = list(queries())
    assert len(names) == len(set(names))
    assert set(SQL) <= set(names)
