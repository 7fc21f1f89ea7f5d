"""Law tests: twins written in the DSL and in SQL return the same rows, and a
query's hot-key plan returns the same rows as its plain plan."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

TWINS = [
    ("account_summary", "account_summary_sql"),
    ("rolling_avg", "rolling_avg_sql"),
    ("rolling_avg", "rolling_avg_split"),
    ("product_windows", "product_windows_sql"),
    ("product_windows", "product_windows_split"),
    ("ranked_income", "ranked_income_split"),
    ("case_when_tier", "case_when_tier_sql"),
    ("parse_date", "parse_date_sql"),
    ("title_case", "title_case_sql"),
    ("account_arrays", "sql_view_chain"),
    ("scholarship_filter_join", "scholarship_join_salted"),
    ("scholarship_filter_join", "scholarship_join_filter"),
    ("posexplode_items", "json_flatten"),
    ("json_inferred", "json_flatten"),
    ("account_rank_by_date", "account_rank_by_date_split"),
    ("account_running_by_date", "account_running_by_date_split"),
    ("job_product_ranking", "product_windows"),
]


def _rows(df, cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("a,b", TWINS)
def test_twins_agree(spark, a, b):
    qs = entry.queries()
    da, db = qs[a](spark, SF_SMALL), qs[b](spark, SF_SMALL)
    common = sorted(set(da.columns) & set(db.columns))
    assert set(db.columns) <= set(da.columns)
    assert _rows(da, common) == _rows(db, common)


def test_dropmalformed_is_permissive_without_bad_cells(spark):
    qs = entry.queries()
    permissive = qs["csv_permissive"](spark, SF_SMALL)
    strict = qs["csv_dropmalformed"](spark, SF_SMALL)
    cols = permissive.columns
    assert _rows(strict, cols) == _rows(permissive.dropna(), cols)
