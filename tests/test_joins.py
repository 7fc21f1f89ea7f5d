from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.joins import broadcast_if_small, cross_with_equality, join_on_key, salted_join
from tessera.plans import scholarship
from tessera.plans.inspect import plan_text
from tests.conftest import SF_SMALL


def test_join_type_counts(employees_df, roles_df):
    counts = {
        how: join_on_key(employees_df, roles_df, "id", how).count()
        for how in ["inner", "left", "right_outer", "full", "left_anti"]
    }
    assert counts == {"inner": 4, "left": 8, "right_outer": 7, "full": 11, "left_anti": 4}


def test_left_anti_keeps_left_columns_only(employees_df, roles_df):
    out = join_on_key(employees_df, roles_df, "id", "left_anti")
    assert out.columns == employees_df.columns
    assert sorted(r.id for r in out.collect()) == [101, 108, 111, 112]


def test_full_outer_has_one_key_column(employees_df, roles_df):
    out = join_on_key(employees_df, roles_df, "id", "full")
    assert out.columns.count("id") == 1
    assert sorted(r.id for r in out.collect()) == [101, 102, 104, 105, 106, 108, 109, 110, 111, 112, 113]


def test_cross_with_equality_is_inner_without_cartesian(employees_df, roles_df):
    out = cross_with_equality(employees_df, roles_df.withColumnRenamed("id", "rid"), "id", "rid")
    assert out.count() == 4
    plan = plan_text(out)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_checked_broadcast(employees_df, roles_df):
    hinted = join_on_key(employees_df, roles_df, "id", "inner", broadcast_right=True, max_broadcast_rows=10)
    assert "BroadcastHashJoin" in plan_text(hinted)
    # Past the bound no hint is added (the plan is left to the optimizer).
    assert broadcast_if_small(roles_df, 2) is roles_df


def test_three_scholarship_plans_agree(spark):
    a = scholarship.scholarship_filter_join(spark, SF_SMALL)
    b = scholarship.scholarship_join_filter(spark, SF_SMALL)
    c = scholarship.scholarship_cartesian(spark, SF_SMALL)
    cols = sorted(a.columns)
    rows = [sorted(tuple(r) for r in d.select(*cols).collect()) for d in (a, b, c)]
    assert rows[0] == rows[1] == rows[2]
    for d in (a, b, c):
        plan = plan_text(d)
        assert "CartesianProduct" not in plan


def test_filters_pushed_below_join(spark):
    plan = plan_text(scholarship.scholarship_join_filter(spark, SF_SMALL))
    # The predicates on both sides reach the parquet scans.
    assert "EqualTo(o_orderstatus,F)" in plan
    assert "EqualTo(n_name,NATION_5)" in plan


def test_course_join_adds_course_name(spark):
    out = scholarship.scholarship_course(spark, SF_SMALL)
    assert "course_name" in out.columns
    assert out.filter(F.col("course_name").isNull()).count() == 0


def test_salted_join_matches_plain_join_on_skewed_keys(spark):
    # Key 1 holds a third of the rows.
    big = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v")
    )
    small = spark.createDataFrame([(k, f"name{k}") for k in range(0, 60, 2)], "k long, name string")
    for how in ["inner", "left", "left_anti"]:
        want = big.join(small, "k", how)
        got = salted_join(big, small, ["k"], how, max_rows_per_key=200, salts=8)
        assert sorted(got.columns) == sorted(want.columns)
        cols = want.columns
        assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in want.collect())


def test_broadcast_check_bounds_bytes(spark):
    from tessera.operators.joins import fits_broadcast

    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 10_000).alias("blob"))
    assert fits_broadcast(wide, 1000, max_bytes=10 * 1024 * 1024)
    assert not fits_broadcast(wide, 1000, max_bytes=100_000)
    assert broadcast_if_small(wide, 1000, max_bytes=100_000) is wide


def test_broadcast_check_gathers_no_rows(spark):
    """The check is one aggregate: no limit, and no rows sent to one task."""
    from tessera.operators import joins

    seen = []

    class Spy:
        columns = ["id"]

        def agg(self, *cols):
            out = spark.range(100).agg(*cols)
            seen.append(plan_text(out, "simple"))
            return out

    assert joins.fits_broadcast(Spy(), 100)
    assert "Limit" not in seen[0] and "partial_count" in seen[0]


def test_salted_join_with_a_third_of_null_keys(spark):
    big = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 20).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(k, f"name{k}") for k in range(0, 30, 2)] + [(None, "none")], "k long, name string")
    for how in ["inner", "left", "left_anti"]:
        got = salted_join(big, small, ["k"], how, max_rows_per_key=50, salts=8)
        want = big.join(small, "k", how)
        key = lambda r: tuple(str(x) for x in r)
        assert sorted((tuple(r) for r in got.select(*want.columns).collect()), key=key) == sorted((tuple(r) for r in want.collect()), key=key)


def test_salt_is_the_same_when_a_task_runs_again(spark):
    big = spark.range(500).select((F.col("id") % 2).alias("k"), F.col("id").alias("v")).repartition(3)
    plan = plan_text(salted_join(big, spark.range(5).withColumnRenamed("id", "k"), ["k"], "left", max_rows_per_key=10, salts=4))
    assert "rand(" not in plan and "xxhash64" in plan
