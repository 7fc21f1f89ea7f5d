"""Approximate distinct counts from stored, mergeable sketches.

A sketch is a few kilobytes whatever it has counted, and the union of two
sketches is the sketch of both inputs.  So a table of one sketch per fine group
(merchant and day) is written once, appended to as days come in, and merged
upwards to any coarser group, without going back to the rows.  Exact distinct
counts can't be added up like that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base-2 logarithm of a sketch's number of registers.
REGISTERS = 12


def sketch_by(df: DataFrame, keys: list[str], value: str, *, alias: str = "sketch", registers: int = REGISTERS) -> DataFrame:
    """One sketch of the distinct values (int, long, text, binary; NULLs don't count) per group."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, registers).alias(alias))


def merge_sketches(sketches: DataFrame, keys: list[str], *, column: str = "sketch") -> DataFrame:
    """Sketches of coarser groups; no keys: one sketch of everything."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg(column).alias(column))


def estimated(column: str = "sketch") -> Column:
    """The distinct count a sketch stands for, the same however the sketch was put together.

    A sketch that has only seen rows remembers their order for a slightly
    better guess.  United with itself it holds the same registers and forgets
    the order, so merged and direct sketches of the same rows agree.
    """
    return F.hll_sketch_estimate(F.hll_union(column, column))


def relative_error(registers: int = REGISTERS, deviations: float = 3.0) -> float:
    """The stated error of a merged sketch: 1.04 / sqrt(number of registers) a standard deviation."""
    return deviations * 1.04 / 2 ** (registers / 2)
