"""Every registered query against its SQL, over whole sample tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import difference, oracle_connection


@pytest.fixture(scope="module")
def duck(sample):
    return oracle_connection(sample)


def test_every_query_has_sql():
    """The corpus queries, where present, have SQL as far as it can express them."""
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(name == "pipeline" or name.startswith("op") for name in without)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, sample, duck, name):
    frame = entry.queries()[name](spark, sample)
    assert difference(frame, duck, entry.oracle_sql()[name]) is None


def test_entry_gives_rows(spark):
    assert not entry.entry(spark).isEmpty()
