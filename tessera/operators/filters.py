"""Row filters written as Column predicates, so the optimizer can push them
into the scan (and copy them across join keys)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_contains(df: DataFrame, column: str, needle: str, *, case_insensitive: bool = True) -> DataFrame:
    c = F.lower(F.col(column)) if case_insensitive else F.col(column)
    return df.filter(c.contains(needle.lower() if case_insensitive else needle))


def _listed(column: str, values, case_insensitive: bool) -> Column:
    if not case_insensitive:
        return F.col(column).isin(list(values))
    return F.lower(F.col(column)).isin([v.lower() if isinstance(v, str) else v for v in values])


def where_in(df: DataFrame, column: str, values, *, case_insensitive: bool = True) -> DataFrame:
    """``IN`` with a list (or any iterable) of values; without regard to case,
    the listed words are lower-cased like the column."""
    return df.filter(_listed(column, values, case_insensitive))


def where_not_in(df: DataFrame, column: str, values, *, case_insensitive: bool = True) -> DataFrame:
    """``NOT IN``; rows whose value is NULL are dropped (SQL three-valued logic)."""
    return df.filter(~_listed(column, values, case_insensitive))


def where_sql(df: DataFrame, condition: str) -> DataFrame:
    """Filter given as SQL text; it may use columns that a later projection drops."""
    return df.filter(condition)


def all_of(*conditions: Column) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
