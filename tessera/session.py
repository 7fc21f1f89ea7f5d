"""Session factory and the shared working folder.

Only settings that differ from Spark 4.1 defaults are set here: the session
time zone is pinned to UTC (driver tables carry ``timestamp_ntz``), adaptive
execution with skew-join splitting is switched on, and the shuffle width is a
parameter so a cluster can size it to its data.  ANSI mode stays on (the
default); operators use ``try_*`` forms instead of switching it off.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    app_name: str = "tessera",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    *,
    input_bytes: int | None = None,
    total_cores: int | None = None,
) -> SparkSession:
    """A session with the settings above.

    Master and shuffle width are left to spark-submit unless given.  With
    ``input_bytes`` and ``total_cores`` the widths come from :func:`scale_conf`.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if input_bytes is not None and total_cores is not None:
        conf |= scale_conf(input_bytes, total_cores)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in (conf | (extra_conf or {})).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` (or one already set on the
    context) is used as is.  Only a local master, as in tests, may go without:
    there a fresh local folder is made and registered.  On a cluster executors
    would write to their own disks, so a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_CLEANED: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder for staged tables.

    All of an application's folders lie in one, which is deleted when the
    driver's JVM ends (results are read lazily, so not before).
    """
    app = spark.sparkContext.applicationId
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-stage/{app}"
    if base not in _CLEANED:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(base)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
        _CLEANED.add(base)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's staged tables now; results not yet read can't be read afterwards."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-stage/{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    This cuts lineage in one pass over the input (a reliable ``checkpoint()``
    of an uncached frame computes it twice), and the stored table survives
    the loss of an executor.  Use it for bounded intermediates that are read
    more than once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # no job to infer what is known


def staged(spark: SparkSession, name: str, write) -> str:
    """Stage an input file: ``write(path)`` writes a rendering of a driver table
    (CSV, text, JSON), standing in for a landed file.

    Every call writes anew, so a query never reads a rendering of older data.
    """
    path = scratch_path(spark, name)
    write(path)
    return path


def scale_conf(input_bytes: int, total_cores: int, *, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings that keep shuffle partitions and file splits near ``partition_bytes``.

    The initial shuffle width follows the input size (and is at least three
    waves of the cluster's cores); adaptive execution then coalesces small
    partitions toward the advisory size and splits skewed ones, so tasks fit
    in executor memory instead of spilling.  Example: 100 TB on 1000 executors
    x 8 cores gives about 400k shuffle partitions and 256 MB splits.
    """
    width = max(3 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }
