"""Sorting and top-k.

``orderBy(...).limit(k)`` is planned as ``TakeOrderedAndProject``: each task
keeps its own k best rows and only those reach the final merge, so a top-k
never sorts or moves the whole table.  Tie-breakers make the k rows
deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def preview(df: DataFrame, key: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by a key (an unsorted ``limit`` returns arbitrary rows)."""
    return df.orderBy(*[F.col(k).asc() for k in key]).limit(n)


def sort_nulls_last(df: DataFrame, column: str, *, descending: bool = False, tiebreak: list[str] = ()) -> DataFrame:
    c = F.col(column)
    first = c.desc_nulls_last() if descending else c.asc_nulls_last()
    return df.orderBy(first, *[F.col(t).asc() for t in tiebreak])
