"""Layouts that later reads profit from: clustered for data skipping, bucketed for joins.

*Clustered*: within each partition directory rows are sorted along a curve
that interleaves the bits of several columns, so every row group covers a
narrow range of each of them.  A filter on any of the columns then finds most
row groups excluded by the min/max in their footers.  Parquet Bloom filters
do the same for equality on a key of no useful order.

*Bucketed*: two tables hashed on the join key into the same number of buckets
are joined bucket by bucket, with no exchange on either side.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.windows import free_prefix
from tessera.session import scratch_path

#: Bits per clustered column: 64 ranges of about equal row counts.
CURVE_BITS = 6

MAX_BUCKETS_CONF = "spark.sql.sources.bucketing.maxBuckets"


def _rank_ranges(df: DataFrame, columns: list[str], bits: int) -> list[list[float]]:
    """Per column the values that cut its rows into 2**bits ranges of about equal size (one aggregate)."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    cuts = df.agg(*[F.percentile_approx(_number(df, c), shares, 10_000).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return [sorted(set(c or [])) for c in cuts]


def _number(df: DataFrame, name: str) -> Column:
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    raise ValueError(f"{name}: only numbers, dates and times can be clustered")


def _range_number(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts lie below the value (NULL: none)."""
    known = F.array(*[F.lit(float(x)) for x in cuts]) if cuts else F.array().cast("array<double>")
    below = F.size(F.filter(known, lambda x: x < value))
    return F.when(value.isNull(), 0).otherwise(below)


def curve_position(df: DataFrame, columns: list[str], bits: int = CURVE_BITS) -> Column:
    """Position on the curve: the bits of each column's range number, interleaved (NULL: range 0)."""
    position = F.lit(0).cast("long")
    for at, (name, cuts) in enumerate(zip(columns, _rank_ranges(df, columns, bits), strict=True)):
        number = _range_number(_number(df, name), cuts)
        for b in range(bits):
            bit = F.shiftright(number, b).bitwiseAND(1).cast("long")
            position = position + F.shiftleft(bit, b * len(columns) + at)
    return position


def write_clustered(
    df: DataFrame,
    path: str,
    cluster_cols: list[str],
    *,
    partition_cols: list[str] = (),
    bloom_cols: dict[str, int] | None = None,
    row_group_bytes: int | None = None,
    mode: str = "overwrite",
) -> str:
    """Write Parquet clustered by ``cluster_cols`` within ``partition_cols``.

    Rows are range-partitioned on (partition columns, curve), so files come out
    even whatever the distribution, and are sorted on it.  ``bloom_cols`` maps
    columns to their expected number of distinct values in a row group; they
    get Bloom filters.
    """
    curve = f"{free_prefix(df)}curve"
    order = [*[F.col(c) for c in partition_cols], F.col(curve)]
    rows = df.withColumn(curve, curve_position(df, cluster_cols))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop(curve)
    writer = rows.write.mode(mode)
    for name, distinct in (bloom_cols or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true").option(f"parquet.bloom.filter.expected.ndv#{name}", str(distinct))
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)
    return path


def bucket_count(spark: SparkSession, wanted: int | None = None) -> int:
    """Buckets for a table: the shuffle width unless given, within what Spark allows."""
    most = int(spark.conf.get(MAX_BUCKETS_CONF, "100000"))
    return max(1, min(wanted or int(spark.conf.get("spark.sql.shuffle.partitions")), most))


def write_bucketed(df: DataFrame, keys: list[str], *, buckets: int | None = None, name: str = "bucketed") -> DataFrame:
    """Store ``df`` hashed on ``keys`` into buckets (one sorted file each) in the shared folder; returns the stored rows.

    Spark keeps bucketing in the catalog only, so a table name is registered to
    write and taken away again; the returned frame still knows its buckets, and
    no name is left behind if the driver dies later.  One shuffle now saves one
    in every later join or aggregate on the same keys.
    """
    spark = df.sparkSession
    n = bucket_count(spark, buckets)
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    writer = df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).format("parquet")
    try:
        writer.option("path", scratch_path(spark, table)).saveAsTable(table)
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def join_stored(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Merge join of two frames of :func:`write_bucketed` on their bucket keys: no exchange on either side."""
    return left.join(right.hint("merge"), on=keys, how=how)
