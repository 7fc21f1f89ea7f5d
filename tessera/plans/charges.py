"""Order-charge profile and year-partitioned layout (``lineitem`` / ``orders``).

Boro = ``l_returnflag``, Zip = ``l_suppkey`` as text, OMOCreateDate =
``l_shipdate``; OrderYear = calendar year of ``o_orderdate``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalar import safe_cast
from tessera.operators import aggregates as agg
from tessera.operators.layout import hash_partition
from tessera.operators.windows import with_group_aggregate
from tessera.plans.registry import register
from tessera.session import scratch_path, staged
from tessera.sinks.files import write_parquet, write_partitioned
from tessera.sinks.layout import write_clustered
from tessera.sources.files import read_parquet
from tessera.tables import table


def order_charges(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_returnflag").alias("Boro"),
        F.col("l_suppkey").cast("string").alias("Zip"),
        F.col("l_shipdate").alias("OMOCreateDate"),
        "l_quantity",
        "l_extendedprice",
    )


@register(
    "agg_dict_count",
    "SELECT l_returnflag AS Boro, count(l_returnflag) AS OrderFrequency FROM lineitem GROUP BY l_returnflag",
)
def agg_dict_count(spark: SparkSession, sf: str) -> DataFrame:
    charges = order_charges(spark, sf)
    # Dict-style aggregate, then the generated name is renamed.
    return charges.groupBy("Boro").agg({"Boro": "count"}).withColumnRenamed("count(Boro)", "OrderFrequency")


@register("zip_list_by_group", "SELECT DISTINCT l_returnflag AS Boro, l_suppkey AS Zip FROM lineitem")
def zip_list_by_group(spark: SparkSession, sf: str) -> DataFrame:
    """The zip codes of each district, one row each: a district's list has no bound at scale."""
    return agg.distinct_values_by(order_charges(spark, sf), "Boro", safe_cast("Zip", "long"))


@register(
    "zip_count_by_group",
    "SELECT l_returnflag AS Boro, count(DISTINCT l_suppkey) AS ZipCount FROM lineitem GROUP BY l_returnflag",
)
def zip_count_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return order_charges(spark, sf).groupBy("Boro").agg(F.count_distinct(safe_cast("Zip", "long")).alias("ZipCount"))


# Zip codes a chunk holds here; small, so that the test tables have several chunks.
ZIP_CHUNK = 64


@register(
    "zip_arrays_by_group",
    f"""
    WITH zips AS (SELECT DISTINCT l_returnflag AS Boro, l_suppkey AS z FROM lineitem),
    cut AS (SELECT *, (row_number() OVER (PARTITION BY Boro ORDER BY z) - 1) // {ZIP_CHUNK} AS chunk, count(*) OVER (PARTITION BY Boro) AS total FROM zips)
    SELECT Boro, CAST(chunk AS BIGINT) AS chunk, array_to_string(list(z ORDER BY z), ',') AS Zips, count(*) AS ZipCount, total AS TotalZips
    FROM cut GROUP BY Boro, chunk, total
    """,
)
def zip_arrays_by_group(spark: SparkSession, sf: str) -> DataFrame:
    """The set of zip codes of each district as arrays of bounded size, with the exact size of the whole."""
    out = agg.distinct_arrays_by(order_charges(spark, sf), "Boro", safe_cast("Zip", "long"), chunk_size=ZIP_CHUNK)
    return out.withColumn("Zips", F.concat_ws(",", F.col("Zips").cast("array<string>")))


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    charges = order_charges(spark, sf)
    return with_group_aggregate(charges, ["OMOCreateDate"], F.count("l_orderkey"), "OMODailyFreq")


@register(
    "daily_freq",
    """
    SELECT l_orderkey, l_linenumber, l_shipdate AS OMOCreateDate,
           count(l_orderkey) OVER (PARTITION BY l_shipdate) AS OMODailyFreq
    FROM lineitem
    """,
)
def daily_freq(spark: SparkSession, sf: str) -> DataFrame:
    return _daily(spark, sf).select("l_orderkey", "l_linenumber", "OMOCreateDate", "OMODailyFreq")


@register(
    "distinct_rows",
    "SELECT l_shipdate AS OMOCreateDate, count(l_orderkey) AS OMODailyFreq FROM lineitem GROUP BY l_shipdate",
)
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    """(date, frequency) without repeats: the per-key aggregate itself."""
    charges = order_charges(spark, sf)
    daily = charges.groupBy("OMOCreateDate").agg(F.count("l_orderkey").alias("OMODailyFreq"))
    return agg.distinct_rows(daily, "OMOCreateDate", "OMODailyFreq")


_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_TEXT = ["l_returnflag", "l_linestatus"]


def _stat_sql(c: str, number: bool) -> str:
    low, high = f"min({c})", f"max({c})"
    numbers = f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, CAST({low} AS DOUBLE) AS min_value, CAST({high} AS DOUBLE) AS max_value"
    none = ", ".join(f"CAST(NULL AS DOUBLE) AS {a}" for a in ("mean", "stddev", "min_value", "max_value"))
    texts = f"CAST({'NULL' if number else low} AS VARCHAR) AS min_text, CAST({'NULL' if number else high} AS VARCHAR) AS max_text"
    return f"SELECT '{c}' AS \"column\", count({c}) AS n, {numbers if number else none}, {texts} FROM lineitem"


@register("describe_stats", " UNION ALL ".join([_stat_sql(c, True) for c in _NUMERIC] + [_stat_sql(c, False) for c in _TEXT]))
def describe_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Every numeric and text column described, numbers and text in an aggregate each."""
    return agg.column_stats(table(spark, sf, "lineitem"), digits=4)


# --- B1, B2, C10, I17 -----------------------------------------------------


@register("parquet_roundtrip", "SELECT * FROM orders")
def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Write (one file per scan partition, no extra shuffle; a fixed count such
    as the reference's 5 is the ``num_files`` parameter), read back."""
    path = write_parquet(table(spark, sf, "orders"), scratch_path(spark, "orders_parquet"))
    return read_parquet(spark, path)


@register("hash_repartition", "SELECT l_suppkey AS merchant_id, count(*) AS n_rows FROM lineitem GROUP BY l_suppkey")
def hash_repartition(spark: SparkSession, sf: str) -> DataFrame:
    """``repartition(n, key)``, then an aggregate on the key: one shuffle, reused by the aggregate."""
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("merchant_id"))
    return hash_partition(li, 10, "merchant_id").groupBy("merchant_id").agg(F.count(F.lit(1)).alias("n_rows"))


@register("round_robin_write", "SELECT * FROM part")
def round_robin_write(spark: SparkSession, sf: str) -> DataFrame:
    """A fixed number of files by ``repartition(n)``, read back."""
    path = write_parquet(table(spark, sf, "part"), scratch_path(spark, "part_parquet"), num_files=5)
    return read_parquet(spark, path)


def _write_year_layout(spark: SparkSession, sf: str, path: str) -> str:
    o = table(spark, sf, "orders").withColumn("OrderYear", F.year("o_orderdate"))
    return write_partitioned(o, path, ["OrderYear"])


def year_partitioned_orders(spark: SparkSession, sf: str) -> str:
    """Write orders partitioned by calendar year (``OrderYear``); return the path."""
    return _write_year_layout(spark, sf, scratch_path(spark, "orders_by_year"))


@register(
    "partitioned_year_count",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS OrderYear, count(*) AS n_orders FROM orders GROUP BY 1",
)
def partitioned_year_count(spark: SparkSession, sf: str) -> DataFrame:
    by_year = read_parquet(spark, year_partitioned_orders(spark, sf))
    return by_year.groupBy("OrderYear").agg(F.count(F.lit(1)).alias("n_orders"))


# Fixed values of the pruning example: one year, a price threshold.
PRUNE_YEAR = 1998
PRUNE_PRICE = 250000.0


def pruned_orders(by_year: DataFrame) -> DataFrame:
    """Partition filter (directory pruning) plus a data filter pushed into the scan."""
    return by_year.select("o_orderkey", "o_custkey", "o_orderpriority", "OrderYear", "o_totalprice").filter(
        (F.col("OrderYear") == PRUNE_YEAR) & (F.col("o_totalprice") > PRUNE_PRICE)
    ).select("o_orderkey", "o_custkey", "o_orderpriority")


@register(
    "partition_pruned_filter",
    f"""
    SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
    WHERE year(o_orderdate) = {PRUNE_YEAR} AND o_totalprice > {PRUNE_PRICE}
    """,
)
def partition_pruned_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Reads the year layout with pruning."""
    path = staged(spark, "orders_by_year_layout", lambda p: _write_year_layout(spark, sf, p))
    return pruned_orders(read_parquet(spark, path))


# Fixed values of the two-column filter.
CLUSTER_CUSTOMERS = (100, 220)
CLUSTER_PRICES = (120000.0, 180000.0)


def write_order_clusters(spark: SparkSession, sf: str, path: str, row_group_bytes: int | None = None) -> str:
    """Orders by year, clustered by customer and price within it, with Bloom filters on the order key."""
    o = table(spark, sf, "orders").withColumn("OrderYear", F.year("o_orderdate"))
    return write_clustered(
        o, path, ["o_custkey", "o_totalprice"], partition_cols=["OrderYear"], bloom_cols={"o_orderkey": 100_000}, row_group_bytes=row_group_bytes
    )


@register(
    "clustered_two_column_filter",
    f"""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_custkey BETWEEN {CLUSTER_CUSTOMERS[0]} AND {CLUSTER_CUSTOMERS[1]}
      AND o_totalprice BETWEEN {CLUSTER_PRICES[0]} AND {CLUSTER_PRICES[1]} AND year(o_orderdate) >= {PRUNE_YEAR - 4}
    """,
)
def clustered_two_column_filter(spark: SparkSession, sf: str) -> DataFrame:
    """A filter on two data columns and the year over the clustered layout: directories, then row groups are skipped."""
    orders = read_parquet(spark, write_order_clusters(spark, sf, scratch_path(spark, "orders_clustered")))
    wanted = F.col("o_custkey").between(*CLUSTER_CUSTOMERS) & F.col("o_totalprice").between(*CLUSTER_PRICES)
    return orders.where((F.col("OrderYear") >= PRUNE_YEAR - 4) & wanted).select("o_orderkey", "o_custkey", "o_totalprice")
