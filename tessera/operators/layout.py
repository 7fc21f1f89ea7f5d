"""Physical layout: repartitioning and partition inspection.

``repartition(n, key)`` before a ``groupBy(key)`` is left out of the query
operators on purpose: the aggregate then skips its map-side partial step and
shuffles raw rows.  These helpers are for layout before writes and for
inspection.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hash_partition(df: DataFrame, num_partitions: int, *keys: str) -> DataFrame:
    """Hash-partition on ``keys`` into ``num_partitions`` partitions."""
    return df.repartition(num_partitions, *keys)


def round_robin(df: DataFrame, num_partitions: int) -> DataFrame:
    return df.repartition(num_partitions)


def rebalance(df: DataFrame, *keys: str) -> DataFrame:
    """Adaptive rebalance: partition sizes chosen at run time (and skew split)."""
    return df.hint("rebalance", *keys)


def merge_partitions(df: DataFrame, num_partitions: int = 1) -> DataFrame:
    """Fewer partitions without a shuffle (``coalesce``)."""
    return df.coalesce(num_partitions)


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition, computed on the executors (``partition``, ``rows``);
    partitions without rows count 0.  Each task sends one row."""

    def count(batches):
        rows = sum(batch.num_rows for batch in batches)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([rows], pa.int64())], ["partition", "rows"])

    return df.select(F.lit(1).alias("one")).mapInArrow(count, "partition int, rows long")
