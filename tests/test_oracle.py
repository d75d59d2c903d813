"""A sample of the registered queries against plain SQL; check_oracle.py runs them all."""

import re

import pytest
from conftest import SF

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare


def test_every_query_has_an_oracle():
    """Those of the corpus package, where it is present, have other tests."""
    mine = {q for q in queries() if not re.match(r"op\d+_|pipeline$", q)}
    assert mine <= set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 12


@pytest.mark.parametrize(
    "name",
    ["fact_sales", "rfm_segmentation", "abc_analysis", "cohort_matrix", "return_rate_analysis",
     "quality_issues", "quality_summary", "agg_daily_sales"],
)
def test_matches_sql(spark, name):
    ok, note = compare(spark, SF, name, oracle_sql()[name])
    assert ok, note
