"""File sinks and view registration.

A plain write adds no shuffle: one file per input partition, and input
partitions are already sized by the scan (``maxPartitionBytes``) or by
adaptive coalescing after a shuffle.  ``rebalance=True`` asks for an adaptive
rebalance (``hint("rebalance")``) when upstream partitions are small or
uneven.  Partitioned writes always rebalance on the partition columns, so each
task writes few directories and adaptive execution splits a large partition
value into many files.  A fixed count or one partition stays available as an
explicit parameter (``num_files``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _shape(
    df: DataFrame, num_files: int | None, rebalance_cols: list[str] | None = None, rebalance: bool = False
) -> DataFrame:
    if num_files == 1:
        return df.coalesce(1)
    if num_files:
        return df.repartition(num_files, *rebalance_cols) if rebalance_cols else df.repartition(num_files)
    if rebalance_cols:
        return df.hint("rebalance", *rebalance_cols)
    return df.hint("rebalance") if rebalance else df


def write_parquet(
    df: DataFrame, path: str, *, mode: str = "overwrite", num_files: int | None = None, rebalance: bool = False
) -> str:
    _shape(df, num_files, rebalance=rebalance).write.mode(mode).parquet(path)
    return path


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: list[str],
    *,
    fmt: str = "parquet",
    mode: str = "overwrite",
    options: dict[str, str] | None = None,
    dynamic: bool = False,
) -> str:
    """Directory-per-value layout (``partitionBy``) for partition pruning.

    Rows are rebalanced on the partition columns first, so each task writes
    few directories.  Choose low-cardinality columns (a year, a flag): one
    directory per id does not scale.  ``overwrite`` replaces the whole layout;
    with ``dynamic`` only the partitions that the new rows have.
    """
    writer = (
        _shape(df, None, partition_cols)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(*partition_cols)
        .format(fmt)
    )
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save(path)
    return path


def write_csv(
    df: DataFrame,
    path: str,
    *,
    header: bool = True,
    sep: str = ",",
    mode: str = "overwrite",
    partition_cols: list[str] | None = None,
) -> str:
    opts = {"header": str(header).lower(), "sep": sep}
    if partition_cols:
        return write_partitioned(df, path, partition_cols, fmt="csv", mode=mode, options=opts)
    _shape(df, None).write.mode(mode).options(**opts).csv(path)
    return path


def write_text_lines(df: DataFrame, path: str, column: str = "value", mode: str = "overwrite") -> str:
    _shape(df.select(column), None).write.mode(mode).text(path)
    return path


def write_format(df: DataFrame, path: str, fmt: str, *, mode: str = "overwrite") -> str:
    """Write in any registered format (``orc``; ``avro`` when its module is present)."""
    _shape(df, None).write.mode(mode).format(fmt).save(path)
    return path


def append_json(df: DataFrame, path: str) -> str:
    """Append documents to a JSON-lines collection (NULL fields are left out of each record)."""
    _shape(df, None).write.mode("append").json(path)
    return path


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Register or replace a session temp view and return the view as a DataFrame."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
