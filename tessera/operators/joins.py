"""Join operators.

Joins go through Catalyst: it chooses broadcast-hash, shuffle-hash or
sort-merge from table statistics, and adaptive execution re-plans at run time
(switching to a broadcast when a shuffled side turns out small, and splitting
skewed partitions of a sort-merge join).  A broadcast is only *forced* behind a
checked row count and size (:func:`broadcast_if_small`); past the bound the join
falls back to the shuffled plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.windows import free_prefix

JOIN_TYPES = {
    "inner": "inner",
    "left": "left",
    "left_outer": "left",
    "right": "right",
    "right_outer": "right",
    "full": "full",
    "full_outer": "full",
    "outer": "full",
    "left_anti": "left_anti",
    "anti": "left_anti",
    "left_semi": "left_semi",
}

# Bounds under which a side may be broadcast on purpose: rows and bytes.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True if ``df`` has at most ``max_rows`` rows whose encoded size is at most ``max_bytes``.

    One aggregate, summed in the tasks that read the rows: no rows move, and
    none are gathered in one task.  The size is the length of each row written
    as JSON, a close stand-in for its in-memory size.
    """
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return stats["n"] <= max_rows and (stats["b"] or 0) <= max_bytes


def broadcast_if_small(
    df: DataFrame,
    max_rows: int = DEFAULT_BROADCAST_ROWS,
    *,
    materialize: bool = False,
    max_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Mark ``df`` for broadcast only when its row count and size are proven under the bounds.

    For a side that is itself computed (an aggregate, a join), pass
    ``materialize=True``: it is stored once as a table in the shared
    checkpoint folder, so the size check and the join read the stored rows
    instead of computing the side twice.  Past either bound the side is returned
    unmarked and the optimizer plans a shuffled join.
    """
    if materialize:
        from tessera.session import materialize as store

        df = store(df, "broadcast_side")
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def join_on_key(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    right_key: str | None = None,
    *,
    broadcast_right: bool = False,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    materialize_right: bool = False,
) -> DataFrame:
    """Equi-join on one key column that appears once in the result.

    The right key is renamed to the left key's name and the join is written
    with ``on=key`` (a USING join), so the result has no ambiguous duplicate
    key; for a full outer join Spark coalesces the two keys.
    """
    join_type = JOIN_TYPES[how]
    if right_key and right_key != key:
        right = right.withColumnRenamed(right_key, key)
    if broadcast_right:
        right = broadcast_if_small(right, max_broadcast_rows, materialize=materialize_right)
    return left.join(right, on=key, how=join_type)


def join_on_condition(left: DataFrame, right: DataFrame, condition: Column, how: str = "inner") -> DataFrame:
    """Join on an arbitrary boolean condition (both sides' columns kept)."""
    return left.join(right, on=condition, how=JOIN_TYPES[how])


def cross_with_equality(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """A "cross" join carrying an equality condition returns the inner-join rows.

    It is expressed as the inner equi-join it is, so no Cartesian product is
    ever planned.
    """
    return left.join(right, on=left[left_key] == right[right_key], how="inner")


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "inner",
    *,
    hot_keys: DataFrame | None = None,
    max_rows_per_key: int = 2_000_000,
    salts: int = 32,
) -> DataFrame:
    """Equi-join that spreads hot keys of ``big`` over ``salts`` tasks.

    Rows of ``big`` whose key is hot get a salt in ``[0, salts)``; the rows of
    ``small`` with a hot key are repeated once per salt (a bounded copy: at
    most hot keys x salts rows); all other rows use salt 0.  Rows of ``big``
    with a NULL in the key match nothing and are spread over all salts.  The
    salt is a hash of the row, so a task that runs again draws the same.
    Adaptive execution already splits skewed partitions of inner sort-merge
    joins; this covers the joins it cannot split (the preserved side of an
    outer join, or when its thresholds are not met).  ``how`` is one of inner,
    left (``big`` preserved) or left_anti.
    """
    from tessera.session import materialize

    if how not in ("inner", "left", "left_outer", "left_anti"):
        raise ValueError("salted_join supports inner, left and left_anti joins")
    p = free_prefix(big, small)
    salt, is_hot, n = f"{p}salt", f"{p}hot", f"{p}n"
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    if hot_keys is None:
        counts = big.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
        hot_keys = materialize(counts.where(F.col(n) > max_rows_per_key).select(*keys), "join_hot_keys")
    hot = broadcast_if_small(hot_keys.select(*keys).distinct().withColumn(is_hot, F.lit(True)), DEFAULT_BROADCAST_ROWS)
    hashable = [f.name for f in big.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    row_salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashable]), F.lit(salts)).cast("int")
    # The salt is drawn from the row as it came, before any column is added to it.
    drawn = big.withColumn(f"{p}row_salt", row_salt).join(hot, on=keys, how="left")
    salted_big = drawn.withColumn(salt, F.when(F.col(is_hot) | ~present, F.col(f"{p}row_salt")).otherwise(F.lit(0))).drop(is_hot, f"{p}row_salt")
    spread = F.when(F.col(is_hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_small = small.join(hot, on=keys, how="left").withColumn(salt, F.explode(spread)).drop(is_hot)
    return salted_big.join(salted_small, on=[*keys, salt], how=JOIN_TYPES[how]).drop(salt)
