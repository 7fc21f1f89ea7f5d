"""Nested data: building and flattening arrays of structs.

Flattening (``explode`` / ``posexplode``) is a narrow, per-row generator: no
shuffle.  Building nested records from flat rows needs a ``groupBy``; to keep
any one record bounded when a parent key has very many children, children
are packed into chunks of at most ``chunk_size`` elements (one record per
chunk, with the position of its first element), so no single group is ever
collected whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.windows import OrderSpec, free_prefix, with_rank_columns


def nest_children(
    df: DataFrame,
    parent: str,
    order: str,
    fields: list[str],
    *,
    parent_alias: str,
    array_alias: str,
    first_alias: str = "first_position",
    chunk_size: int = 64,
    **window_options,
) -> DataFrame:
    """Group child rows under their parent as ``array<struct<order, fields…>>``.

    Children are numbered per parent by ``order`` (hot parents are split, see
    :mod:`tessera.operators.windows`) and packed ``chunk_size`` to a record, so
    no parent is gathered whole.  ``first_alias`` is the position of a record's
    first child in the whole parent.
    """
    p = free_prefix(df)
    position, children = f"{p}position", f"{p}children"
    numbered = with_rank_columns(
        df, [parent], OrderSpec(order, tiebreak=fields), order, lags=[],
        row_number_alias=position, rank_alias=f"{p}rank", dense_rank_alias=f"{p}dense", **window_options,
    )
    first = F.floor((F.col(position) - 1) / chunk_size) * chunk_size
    element = F.struct(F.col(order), *[F.col(f) for f in fields])
    packed = numbered.groupBy(F.col(parent).alias(parent_alias), first.alias(first_alias)).agg(
        F.array_sort(F.collect_list(F.struct(position, element.alias(f"{p}child")))).alias(children)
    )
    return packed.select(parent_alias, first_alias, F.transform(children, lambda x: x[f"{p}child"]).alias(array_alias))


def explode_field(df: DataFrame, keep: list[str], array_col: str, alias: str) -> DataFrame:
    """One row per element; rows with an empty or NULL array are dropped."""
    return df.select(*keep, F.explode(F.col(array_col)).alias(alias))


def posexplode_field(
    df: DataFrame, keep: list[str], array_col: str, pos_alias: str, alias: str, *, first: str | None = None
) -> DataFrame:
    """One row per element with its 0-based position.

    Where a parent is kept in several records, ``first`` names the column that
    holds the position of the record's first element in the whole parent.
    """
    if first is None:
        return df.select(*keep, F.posexplode(F.col(array_col)).alias(pos_alias, alias))
    p = free_prefix(df)
    rows = df.select(*keep, F.col(first).alias(f"{p}first"), F.posexplode(F.col(array_col)).alias(f"{p}at", alias))
    return rows.select(*keep, (F.col(f"{p}first") + F.col(f"{p}at")).cast("long").alias(pos_alias), alias)
