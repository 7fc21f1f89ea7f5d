"""Array helpers: stable text forms of sets, size, membership, descending sort."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_text(arr, sep: str = ",") -> Column:
    """An unordered set (``collect_set``) as deterministic text: sorted, joined."""
    return F.array_join(F.array_sort(F.col(arr) if isinstance(arr, str) else arr), sep)


def sorted_desc_text(arr, sep: str = ",") -> Column:
    """``sort_array(arr, asc=False)`` as text (NULLs last when descending)."""
    return F.array_join(F.sort_array(F.col(arr) if isinstance(arr, str) else arr, asc=False), sep)


def array_profile(arr: str, member: str) -> list[Column]:
    """Size, descending order and membership test of one array column."""
    c = F.col(arr)
    return [
        F.size(c).cast("long").alias("CountOfUniqueTransactionTypes"),
        sorted_desc_text(c).alias("OrderedUniqueTransactionDescriptions"),
        F.array_contains(c, member).alias("WentToMovies"),
    ]
