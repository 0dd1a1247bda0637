"""Every query with SQL gives the rows DuckDB gives."""

import pytest

import __spark_entry__ as entry
from catalogue import ORACLES, QUERIES
from tests.compare import difference


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, folder, name):
    assert difference(spark, folder, name) is None


def test_entry_names():
    assert set(entry.oracle_sql()) <= set(entry.queries()) >= set(QUERIES)
