"""The SQL texts against the reports and checks they stand for."""

import pytest

from quotewright.plans.reports import CHECKS, REPORTS
from quotewright.plans.sql_texts import STATEMENTS, statement
from quotewright.sources import sample_tables
from quotewright.sources.catalog import register_view
from tests.compare import rows_of


@pytest.fixture(scope="module")
def views(spark, sample, curated):
    register_view(curated)
    register_view(sample_tables.faulty_from_events(spark, sample), "faulty_quotes")
    register_view(sample_tables.valid_from_events(spark, sample), "valid_quotes")
    return {"dq_dup_keys": "valid_quotes", "dq_dup_rows": "valid_quotes"}


def test_each_report_and_check_has_a_text():
    assert set(STATEMENTS) == {*REPORTS, *CHECKS} - {"dq_report"}


@pytest.mark.parametrize("name", STATEMENTS)
def test_text_and_function_agree(spark, views, name):
    view = views.get(name, "faulty_quotes" if name in CHECKS else "curated_quotes")
    ours = {**REPORTS, **CHECKS}[name](spark.table(view))
    theirs = spark.sql(statement(name, view))
    assert theirs.columns == ours.columns
    assert theirs.dtypes == ours.dtypes
    found = rows_of(ours.columns, ours.collect())
    assert rows_of(theirs.columns, theirs.collect()) == found and found[1]
