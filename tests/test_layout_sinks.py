"""Clustered and bucketed layouts: what the footers exclude, what the plans leave out."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.plans import charges, scholarship
from tessera.plans.inspect import count_nodes, plan_text, pushed_filters
from tessera.plans.standins import courses, demographics, finance_flags
from tessera.sinks.files import write_partitioned
from tessera.sinks.layout import bucket_count, curve_position, join_stored, write_bucketed, write_clustered
from tests.conftest import SF_ORACLE


def _row_groups(path):
    """(min, max) per column of every row group, from the written footers."""
    out = []
    for name in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            cols = [meta.row_group(g).column(i) for i in range(meta.num_columns)]
            out.append({c.path_in_schema: (c.statistics.min, c.statistics.max) for c in cols if c.statistics is not None and c.statistics.has_min_max})
    return out


def _excluded(groups, column, low, high):
    """Share of the row groups that a filter low <= column <= high need not read."""
    return sum(g[column][1] < low or g[column][0] > high for g in groups) / len(groups)


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF_ORACLE}/orders.parquet").withColumn("OrderYear", F.year("o_orderdate"))


def test_row_groups_are_skipped_on_either_column(spark, orders, tmp_dir):
    plain = write_partitioned(orders, f"{tmp_dir}/plain", ["OrderYear"])
    clustered = charges.write_order_clusters(spark, SF_ORACLE, f"{tmp_dir}/clustered", row_group_bytes=4 * 1024)
    assert spark.read.parquet(clustered).count() == orders.count()
    for column, low, high in (("o_custkey", *charges.CLUSTER_CUSTOMERS), ("o_totalprice", *charges.CLUSTER_PRICES)):
        groups = _row_groups(clustered)
        assert len(groups) > 20
        assert _excluded(groups, column, low, high) > 0.4
        assert _excluded(_row_groups(plain), column, low, high) < 0.1
    both = [g for g in _row_groups(clustered) if g["o_custkey"][1] >= 100 and g["o_custkey"][0] <= 220 and g["o_totalprice"][1] >= 120000 and g["o_totalprice"][0] <= 180000]
    assert len(both) < 0.35 * len(_row_groups(clustered))


def test_filters_reach_the_clustered_scan(spark):
    df = charges.clustered_two_column_filter(spark, SF_ORACLE)
    assert any("o_custkey" in f and "o_totalprice" in f for f in pushed_filters(df))
    assert "PartitionFilters: [isnotnull(OrderYear" in plan_text(df)


def test_bloom_filters_are_written_for_the_key(spark, orders, tmp_dir):
    path = write_clustered(orders, f"{tmp_dir}/bloom", ["o_custkey"], bloom_cols={"o_orderkey": 1000})
    plain = write_clustered(orders, f"{tmp_dir}/none", ["o_custkey"])
    size = lambda p: sum(len(open(n, "rb").read()) for n in glob.glob(f"{p}/*.parquet"))
    assert size(path) > size(plain) + 1000
    key = orders.agg(F.max("o_orderkey")).first()[0]
    assert spark.read.parquet(path).where(F.col("o_orderkey") == key).count() == 1


def test_curve_interleaves_ranges_of_any_distribution(spark):
    df = spark.range(4096).select((F.col("id") % 64).alias("a"), F.pow(F.lit(1.2), F.floor(F.col("id") / 64)).alias("b"), F.lit(None).cast("double").alias("c"))
    got = df.select("a", "b", curve_position(df, ["a", "b"], bits=2).alias("z"), curve_position(df, ["c"]).alias("none")).collect()
    assert {r.z for r in got} == set(range(16)) and {r.none for r in got} == {0}
    sizes = [sum(r.z == z for r in got) for z in range(16)]
    assert max(sizes) < 2 * min(sizes)  # b is heavily skewed, its ranges are not
    with pytest.raises(ValueError, match="clustered"):
        curve_position(spark.createDataFrame([("x",)], "s string"), ["s"])


def test_dates_times_and_ties_cluster(spark, tmp_dir):
    df = spark.range(300).select("id", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("d"), F.timestamp_seconds("id").alias("t"), F.lit(1).alias("same"))
    path = write_clustered(df, f"{tmp_dir}/t", ["d", "t", "same"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(map(tuple, df.collect()))


def test_bucketed_sides_join_without_exchange(spark):
    fin, demo = finance_flags(spark, SF_ORACLE), demographics(spark, SF_ORACLE)
    a, b = write_bucketed(fin, ["id"]), write_bucketed(demo, ["id"])
    joined = join_stored(a, b, ["id"])
    assert count_nodes(joined, "Exchange") == 0 and count_nodes(joined, "BroadcastExchange") == 0 and count_nodes(joined, "SortMergeJoin") == 1
    assert joined.count() == fin.join(demo, "id").count()
    per_key = a.groupBy("id").agg(F.sum("income"))
    assert count_nodes(per_key, "Exchange") == 0


def test_recipients_rekeyed_by_course_need_no_exchange(spark):
    recipients, with_course = scholarship.stored_recipients(demographics(spark, SF_ORACLE), finance_flags(spark, SF_ORACLE), courses(spark, SF_ORACLE))
    for df in (recipients, with_course):
        assert count_nodes(df, "Exchange") == 0 and count_nodes(df, "SortMergeJoin") == 1
    assert with_course.count() == recipients.count() > 0


def test_bucketed_tables_leave_no_name_and_stay_readable(spark):
    before = {t.name for t in spark.catalog.listTables()}
    df = write_bucketed(spark.range(100).withColumn("k", F.col("id") % 5), ["k"], buckets=3)
    assert {t.name for t in spark.catalog.listTables()} == before
    assert df.groupBy("k").count().count() == 5 and df.count() == 100


def test_bucket_count_stays_within_what_spark_allows(spark):
    width = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "400000")
        assert bucket_count(spark) == 100_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    assert bucket_count(spark) == int(width) and bucket_count(spark, 5) == 5
