"""Relational sources and sinks over JDBC.

Reads are split into ``num_partitions`` range queries on a numeric column.
``lower``/``upper`` only set the stride: rows outside the bounds are still
read (they land in the first and last partition), so nothing is lost.  Choose
the bounds from the column's real minimum and maximum
(:func:`column_bounds`) so the partitions are even.

Credentials travel as reader options and are never logged or returned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _options(url: str, user: str | None, password: str | None, driver: str | None) -> dict[str, str]:
    opts = {"url": url}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    return opts


def read_table_partitioned(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    num_partitions: int,
    *,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Parallel table read: one range query per partition on ``partition_column``."""
    return (
        spark.read.format("jdbc")
        .options(**_options(url, user, password, driver))
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", str(num_partitions))
        .option("fetchsize", str(fetch_size))
        .load()
    )


def read_query(
    spark: SparkSession,
    url: str,
    query: str,
    *,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
) -> DataFrame:
    """Read the result of a query pushed to the database (warehouse reads)."""
    return spark.read.format("jdbc").options(**_options(url, user, password, driver)).option("query", query).load()


def column_bounds(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    *,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
) -> tuple[int, int]:
    """Minimum and maximum of ``column``, computed by the database (one row back)."""
    row = read_query(
        spark, url, f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}",
        user=user, password=password, driver=driver,
    ).first()
    return bounds_from_row(row)


def bounds_from_row(row) -> tuple[int, int]:
    """``(lo, hi)`` from a one-row result; databases may upper-case the names."""
    fields = {k.lower(): v for k, v in row.asDict().items()}
    return int(fields["lo"]), int(fields["hi"])


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    *,
    mode: str = "overwrite",
    truncate: bool = True,
    num_partitions: int | None = None,
    batch_size: int = 10_000,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
) -> None:
    """Write to a table.  ``truncate`` keeps the table definition on overwrite;
    ``num_partitions`` caps concurrent connections (instead of one partition)."""
    writer = (
        df.write.format("jdbc")
        .options(**_options(url, user, password, driver))
        .option("dbtable", table)
        .option("truncate", str(truncate).lower())
        .option("batchsize", str(batch_size))
        .mode(mode)
    )
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    writer.save()
