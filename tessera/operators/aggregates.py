"""Grouped aggregation operators.

All of them are a single ``groupBy().agg()`` (or a global ``agg``): Spark runs a
partial aggregate before the shuffle and a final one after it, so a key that
holds a large share of the rows is reduced map-side and never gathers its raw
rows in one task.  Sets are built with ``collect_set``, whose partial buffers
are bounded by the number of *distinct* values, and emitted as sorted text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tessera.functions.arrays import sorted_text
from tessera.functions.scalar import exact, exact_mean
from tessera.operators.windows import OrderSpec, free_prefix, with_rank_columns


def summarize_by_key(
    df: DataFrame,
    key: str,
    amount: str,
    label: str,
    *,
    key_alias: str = "AccountNumber",
    with_mean: bool = True,
    set_as_text: bool = True,
    scale: int | None = None,
) -> DataFrame:
    """Per-key mean, total, count, max, min of an amount and the set of labels.

    Plain ``avg`` and ``sum`` by default.  With ``scale`` the amounts are summed
    as exact decimals of that scale, the total is returned as double and the
    mean is ``double(total) / count``, so results do not depend on row order.
    """
    total = F.sum(exact(amount, scale))
    n = F.count(amount)
    aggs: list[Column] = []
    if with_mean:
        mean = F.avg(amount) if scale is None else exact_mean(total, n)
        aggs.append(mean.alias("AverageTransaction"))
    aggs += [
        (total if scale is None else total.cast("double")).alias("TotalTransaction"),
        n.alias("NumberOfTransaction"),
        F.max(amount).alias("MaxTransaction"),
        F.min(amount).alias("MinTransaction"),
        F.collect_set(label).alias("UniqueTransactionDescriptions"),
    ]
    out = df.groupBy(F.col(key).alias(key_alias)).agg(*aggs)
    if set_as_text:
        out = out.withColumn("UniqueTransactionDescriptions", sorted_text("UniqueTransactionDescriptions"))
    return out


def count_by(df: DataFrame, key: str, alias: str = "OrderFrequency") -> DataFrame:
    """Dict-style ``agg({key: "count"})`` renamed: non-NULL count per key."""
    return df.groupBy(key).agg(F.count(key).alias(alias))


def distinct_values_by(df: DataFrame, key: str, value: Column, *, alias: str = "Zip") -> DataFrame:
    """The distinct values of each key, one row per (key, value).

    A list per key would gather an unbounded set in one task; rows stay spread.
    """
    return df.select(key, value.alias(alias)).distinct()


def distinct_arrays_by(
    df: DataFrame,
    key: str,
    value: Column,
    *,
    chunk_size: int = 100_000,
    alias: str = "Zips",
    count_alias: str = "ZipCount",
    total_alias: str = "TotalZips",
    **window_options,
) -> DataFrame:
    """The distinct values of each key as sorted arrays of at most ``chunk_size``, with their sizes.

    One row per (key, ``chunk``): the sorted set is cut into numbered chunks, so
    no set is gathered whole whatever its size.  The distinct rows are numbered
    by the hot-safe row number (``window_options``: strategy, bound), and
    ``total_alias`` is the exact size of the whole set.  NULL values don't
    count; a key that has nothing else keeps one empty array.
    """
    p = free_prefix(df)
    rows = df.select(F.col(key), value.alias(f"{p}v")).distinct()
    known = rows.where(F.col(f"{p}v").isNotNull())
    numbered = with_rank_columns(
        known, [key], OrderSpec(f"{p}v"), f"{p}v", lags=[], row_number_alias=f"{p}n", rank_alias=f"{p}r", dense_rank_alias=f"{p}d", **window_options
    )
    chunk = F.floor((F.col(f"{p}n") - 1) / chunk_size)
    arrays = numbered.groupBy(F.col(key).alias(f"{p}k"), chunk.alias("chunk")).agg(F.array_sort(F.collect_list(f"{p}v")).alias(alias))
    totals = rows.groupBy(key).agg(F.count(f"{p}v").alias(total_alias))
    out = totals.join(arrays, F.col(key).eqNullSafe(F.col(f"{p}k")), "left")
    empty = F.array().cast(arrays.schema[alias].dataType)
    return out.select(
        key, F.coalesce("chunk", F.lit(0)).alias("chunk"), F.coalesce(alias, empty).alias(alias),
        F.greatest(F.size(alias), F.lit(0)).cast("long").alias(count_alias), total_alias,
    )


def distinct_set_by(
    df: DataFrame, key: str, value: Column, *, list_alias: str = "ZipList", count_alias: str = "ZipCount"
) -> DataFrame:
    """Distinct values per key as sorted text plus their number, for values of a
    bounded domain (postal codes of a district); see :func:`distinct_values_by`."""
    grouped = df.groupBy(key).agg(F.collect_set(value).alias("_set"))
    return grouped.select(
        key,
        F.size("_set").cast("long").alias(count_alias),
        sorted_text("_set").alias(list_alias),
    )


def first_by(df: DataFrame, key, value: str, order: list[str], alias: str) -> DataFrame:
    """Deterministic ``first``: the value at the smallest ordering key (may be NULL)."""
    return df.groupBy(key).agg(F.min_by(F.col(value), F.struct(*order)).alias(alias))


def first_non_null_by(df: DataFrame, key, value: str, order: list[str], alias: str) -> DataFrame:
    """``first(value, ignorenulls=True)`` made deterministic; all-NULL groups give NULL."""
    v = F.col(value)
    ordering = F.when(v.isNotNull(), F.struct(*order))
    return df.groupBy(key).agg(F.min_by(v, ordering).alias(alias))


def max_min_by(df: DataFrame, key, value: str, *, max_alias: str, min_alias: str) -> DataFrame:
    """What sort-then-``first(ignorenulls)`` intends: per-group max and min."""
    return df.groupBy(key).agg(F.max(value).alias(max_alias), F.min(value).alias(min_alias))


def normalized_key(c: str) -> Column:
    """Group key as ``trim(lower(c))``."""
    return F.trim(F.lower(F.col(c)))


def distinct_rows(df: DataFrame, *cols) -> DataFrame:
    return df.select(*cols).distinct()


def count_distinct(df: DataFrame, c: str, alias: str) -> DataFrame:
    """Exact distinct count as one row (no driver-side ``count()``)."""
    return df.agg(F.count_distinct(c).alias(alias))


def approx_distinct(df: DataFrame, c: str, alias: str, rsd: float = 0.05, key: str | None = None) -> DataFrame:
    """HyperLogLog++ distinct count; fixed-size sketch per group, merged after the shuffle."""
    agg = F.approx_count_distinct(c, rsd).alias(alias)
    return df.groupBy(key).agg(agg) if key else df.agg(agg)


def row_count(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def column_stats(df: DataFrame, digits: int | None = None) -> DataFrame:
    """What ``describe()`` tells, typed: one row per numeric or text column.

    ``column, n, mean, stddev, min_value, max_value`` (numbers) and ``min_text,
    max_text`` (text); n counts values that are not NULL, stddev is the sample
    deviation; ``digits`` rounds mean and stddev.  Numbers and text are
    aggregated apart: least and greatest texts have no fixed size, and one of
    them would turn the hash aggregate of all the numbers into a sort.
    """
    rounded = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    numbers, texts = [], []
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    for f in df.schema.fields:
        c, name = F.col(f"`{f.name}`"), F.lit(f.name).alias("column")
        if isinstance(f.dataType, NumericType):
            values = [rounded(F.avg(c).cast("double")), rounded(F.stddev_samp(c)), F.min(c).cast("double"), F.max(c).cast("double"), text, text]
            numbers.append((name, F.count(c), values))
        elif isinstance(f.dataType, StringType):
            texts.append((name, F.count(c), [none, none, none, none, F.min(c), F.max(c)]))
    if not numbers and not texts:
        raise ValueError("no numeric or text column")
    fields = ("mean", "stddev", "min_value", "max_value", "min_text", "max_text")
    parts = []
    for group in (numbers, texts):
        if group:
            stats = [F.struct(name, n.alias("n"), *[v.alias(a) for v, a in zip(values, fields, strict=True)]) for name, n, values in group]
            parts.append(df.agg(F.array(*stats).alias("stats")).select(F.inline("stats")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def describe_table(df: DataFrame, *cols: str) -> DataFrame:
    """Spark's own ``describe()`` (string-typed summary) for interactive use."""
    return df.describe(*cols)
