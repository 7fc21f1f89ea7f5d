from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import aggregates as agg
from tessera.operators import filters, sorting
from tessera.plans.inspect import plan_text


def test_group_counts_raw_and_normalized(people_df):
    assert people_df.groupBy("firstName").count().count() == 6
    assert people_df.groupBy(agg.normalized_key("firstName")).count().count() == 3


def test_max_min_by_normalized_key(people_df):
    out = agg.max_min_by(people_df, agg.normalized_key("firstName").alias("k"), "weightInLbs",
                         max_alias="mx", min_alias="mn")
    got = {r.k: (r.mx, r.mn) for r in out.collect()}
    assert got == {"ula": (88.0, 64.5), "nadia": (None, None), "timo": (101.2, 101.2)}


def test_first_and_first_non_null_are_deterministic(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, 5.0), ("a", 3, 7.0), ("b", 1, None), ("c", 9, 1.0)], "k string, t int, v double"
    )
    first = {r.k: r.f for r in agg.first_by(df, "k", "v", ["t"], "f").collect()}
    assert first == {"a": None, "b": None, "c": 1.0}
    nn = {r.k: r.f for r in agg.first_non_null_by(df, "k", "v", ["t"], "f").collect()}
    assert nn == {"a": 5.0, "b": None, "c": 1.0}


def test_predicates(people_df):
    assert filters.where_contains(people_df, "jobType", "KEEPER").count() == 2
    assert filters.where_in(people_df, "jobType", ["BEEKEEPER", "abc", "Surveyor"]).count() == 3
    assert filters.where_in(people_df, "jobType", ["Beekeeper"], case_insensitive=False).count() == 1
    not_in = filters.where_not_in(people_df, "jobType", ["beeKeeper", "SURVEYOR"])
    assert [r.firstName for r in not_in.collect()] == ["ula"]


def test_summary_exact_and_set_text(spark):
    df = spark.createDataFrame(
        [(1, 0.1, "Movies"), (1, 0.2, "Food"), (1, 0.2, "Movies"), (2, 1.0, None)], "a long, amt double, d string"
    )
    out = {r.AccountNumber: r for r in agg.summarize_by_key(df, "a", "amt", "d", scale=2).collect()}
    assert out[1].TotalTransaction == 0.5 and out[1].NumberOfTransaction == 3
    assert out[1].UniqueTransactionDescriptions == "Food,Movies"
    assert out[2].UniqueTransactionDescriptions == ""


def test_aggregate_is_partial_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    plan = plan_text(agg.summarize_by_key(df, "k", "v", "k"), "simple")
    assert "partial_sum" in plan and "partial_collect_set" in plan


def test_column_stats_match_describe(spark):
    df = spark.createDataFrame([(1.0, "b", 3, True), (2.0, "a", None, False), (4.0, None, 5, None)], "x double, s string, n int, flag boolean")
    got = {r.column: r for r in agg.column_stats(df).collect()}
    assert set(got) == {"x", "s", "n"}
    for c in ("x", "n"):
        d = {r.summary: r[c] for r in agg.describe_table(df, c).collect()}
        assert got[c].n == int(d["count"])
        assert abs(got[c]["mean"] - float(d["mean"])) < 1e-12 and abs(got[c].stddev - float(d["stddev"])) < 1e-12
        assert (got[c].min_value, got[c].max_value) == (float(d["min"]), float(d["max"]))
    assert (got["s"].n, got["s"].min_text, got["s"].max_text, got["s"]["mean"]) == (2, "a", "b", None)


def test_deviation_of_large_close_numbers(spark):
    df = spark.createDataFrame([(1e9,), (1e9 + 1,), (1e9 + 2,)], "x double")
    assert abs(agg.column_stats(df).first().stddev - 1.0) < 1e-9


def test_sums_keep_the_columns_own_type(spark):
    """No scale is forced: thousandths are not lost, large and NaN amounts pass."""
    df = spark.createDataFrame([(1, 0.004), (1, 0.004), (2, 1e17), (3, float("nan")), (3, 1.0)], "k long, v double")
    got = {r.AccountNumber: r for r in agg.summarize_by_key(df, "k", "v", "k").collect()}
    assert (got[1].TotalTransaction, got[1].AverageTransaction) == (0.008, 0.004)
    assert got[2].TotalTransaction == 1e17 and got[3].TotalTransaction != got[3].TotalTransaction


def test_top_k_plan(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("v"))
    top = sorting.top_k(df, [F.col("v").desc(), F.col("id").asc()], 3)
    assert "TakeOrderedAndProject" in plan_text(top, "simple")
    assert [r.id for r in top.collect()] == [6, 13, 20]


def test_sort_nulls_last(people_df):
    out = sorting.sort_nulls_last(people_df, "weightInLbs", tiebreak=["age"])
    assert [r.weightInLbs for r in out.collect()] == [64.5, 88.0, 101.2, None, None, None]


def test_approx_distinct_low_cardinality_exact(spark):
    df = spark.createDataFrame([(s,) for s in "ABCABCAAA"], "s string")
    assert agg.approx_distinct(df, "s", "n").first().n == 3
    assert agg.count_distinct(df, "s", "n").first().n == 3


def test_all_null_groups_give_null_not_errors(spark):
    from tessera.operators.windows import OrderSpec, with_rolling_mean

    df = spark.createDataFrame([(1, 1, None), (1, 2, None), (2, 1, 5.0)], "k long, t long, v double")
    summary = {r.AccountNumber: r.AverageTransaction for r in agg.summarize_by_key(df, "k", "v", "k").collect()}
    assert summary == {1: None, 2: 5.0}
    one = {r.column: r for r in agg.column_stats(df.filter("k = 2")).collect()}["v"]
    assert one["mean"] == 5.0 and one.stddev is None
    assert {r.column: r for r in agg.column_stats(df.filter("k = 1")).collect()}["v"]["mean"] is None
    rolled = {(r.k, r.t): r.RollingAvg for r in with_rolling_mean(df, ["k"], OrderSpec("t"), "v",
                                                                 strategy="window").collect()}
    assert rolled == {(1, 1): None, (1, 2): None, (2, 1): 5.0}
