"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.session import materialize, scratch_path

#: Bytes of text handled by one numpy step inside a task.
SLICE_BYTES = 1 << 20

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this library to the executors once per application (Spark's own file distribution)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="tessera-ship-"), "tessera_lib.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "tessera")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back (cuts lineage, survives lost executors)."""
    return materialize(df, f"llm-{name}")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return scratch_path(spark, f"llm-{name}")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_slices(column: pa.Array, max_bytes: int = SLICE_BYTES):
    """Cut an Arrow text column into row ranges of about ``max_bytes``; yields (first row, row count)."""
    n = len(column)
    if n == 0:
        return
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i in range(n):
        if held and held + int(sizes[i]) > max_bytes:
            yield first, i - first
            first, held = i, 0
        held += int(sizes[i])
    yield first, n - first
