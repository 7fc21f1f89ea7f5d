from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import sketches as sk


def _events(spark, n=40_000):
    return spark.range(n).select(
        (F.col("id") % 6).alias("merchant"), (F.col("id") % 90).alias("day"), F.when(F.col("id") % 10 > 0, F.col("id") * 31 % 7001).alias("customer")
    )


def test_merged_sketches_equal_direct_ones_at_every_level(spark, tmp_dir):
    df = _events(spark)
    sk.sketch_by(df.where("day < 45"), ["merchant", "day"], "customer").write.parquet(f"{tmp_dir}/s")
    sk.sketch_by(df.where("day >= 45"), ["merchant", "day"], "customer").write.mode("append").parquet(f"{tmp_dir}/s")
    stored = spark.read.parquet(f"{tmp_dir}/s")
    for keys in (["merchant"], ["day"], []):
        merged = sk.merge_sketches(stored, keys).select(*keys, sk.estimated().alias("n"))
        direct = sk.sketch_by(df, keys, "customer").select(*keys, sk.estimated().alias("n"))
        assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, direct.collect()))
    # Merging in two steps is merging in one.
    twice = sk.merge_sketches(sk.merge_sketches(stored, ["merchant"]), []).select(sk.estimated()).first()[0]
    assert twice == sk.merge_sketches(stored, []).select(sk.estimated()).first()[0]


def test_estimates_of_thousands_of_values_keep_the_stated_error(spark):
    df = _events(spark)
    exact = {r.merchant: r.n for r in df.groupBy("merchant").agg(F.count_distinct("customer").alias("n")).collect()}
    assert min(exact.values()) > 5000
    for registers in (8, 12, 14):
        got = sk.sketch_by(df, ["merchant"], "customer", registers=registers).select("merchant", sk.estimated().alias("n")).collect()
        assert all(abs(r.n - exact[r.merchant]) <= sk.relative_error(registers, 4) * exact[r.merchant] for r in got)
    assert sk.relative_error(14) < sk.relative_error(12) < 0.05


def test_nulls_and_empty_groups(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 5)], "k int, v long")
    got = sk.merge_sketches(sk.sketch_by(df, ["k"], "v"), ["k"]).select("k", sk.estimated().alias("n")).collect()
    assert sorted(map(tuple, got)) == [(1, 0), (2, 1)]
