from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import windows
from tessera.operators.windows import (
    OrderSpec,
    choose_strategy,
    with_group_aggregate,
    with_income_ranking,
    with_rank_columns,
    with_rolling_mean,
)
from tessera.plans.inspect import count_nodes

EXPECTED_PRODUCTS = {
    # product: (lag1, lag2 default 0, row_number, rank, dense_rank)
    "ladle": (None, 0, 1, 1, 1),
    "sieve": (12, 0, 2, 1, 1),
    "whisk": (12, 12, 3, 1, 1),
    "kettle": (12, 12, 4, 4, 2),
    "pan": (40, 12, 5, 5, 3),
    "trowel": (None, 0, 1, 1, 1),
    "rake": (18, 0, 2, 2, 2),
    "spade": (25, 18, 3, 2, 2),
    "hose": (25, 25, 4, 4, 3),
    "rug": (None, 0, 1, 1, 1),
    "stool": (75, 0, 2, 1, 1),
    "shelf": (75, 75, 3, 3, 2),
}


@pytest.mark.parametrize("strategy", ["window", "split"])
def test_product_windows_fixture(products_df, strategy):
    out = with_rank_columns(
        products_df, ["category"], OrderSpec("revenue", tiebreak=["product"]), "revenue",
        strategy=strategy, max_rows_per_key=1,
    )
    got = {
        r.product: (r.prevRevenue, r.prev2Revenue, r.row_number, r.rev_rank, r.rev_dense_rank)
        for r in out.collect()
    }
    assert got == EXPECTED_PRODUCTS


@pytest.mark.parametrize("strategy", ["window", "split"])
def test_running_total_ties_share(spark, strategy):
    df = spark.createDataFrame([(1, True, 5.0), (2, True, 5.0), (3, True, 9.0)], "id long, k boolean, income double")
    out = with_income_ranking(
        df, ["k"], OrderSpec("income", descending=True, tiebreak=["id"]), "income",
        strategy=strategy, max_rows_per_key=1,
    )
    got = {r.id: (r.ranked, r.windowedSum, r.windowedRunningTotal) for r in out.collect()}
    assert got == {3: (1, 19.0, 9.0), 1: (2, 19.0, 19.0), 2: (3, 19.0, 19.0)}


def _skewed_frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # One key holds about a third of the rows; NULL keys and values occur;
        # values repeat so ties are common.
        r = rnd.random()
        key = "hot" if r < 0.35 else (None if r < 0.40 else f"k{rnd.randint(0, 40)}")
        value = None if rnd.random() < 0.05 else float(rnd.randint(0, 300)) / 4
        rows.append((i, key, value, rnd.randint(0, 50)))
    return spark.createDataFrame(rows, "id long, key string, value double, day int")


def _as_set(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_split_equals_window_on_skewed_data(spark):
    df = _skewed_frame(spark)
    order = OrderSpec("value", tiebreak=["id"])
    cols = ["id", "prevRevenue", "prev2Revenue", "row_number", "rev_rank", "rev_dense_rank"]
    a = with_rank_columns(df, ["key"], order, "value", strategy="window")
    b = with_rank_columns(df, ["key"], order, "value", strategy="split", max_rows_per_key=100)
    assert _as_set(a, cols) == _as_set(b, cols)

    desc = OrderSpec("value", descending=True, tiebreak=["id"])
    cols = ["id", "ranked", "windowedSum", "windowedRunningTotal"]
    a = with_income_ranking(df, ["key"], desc, "value", strategy="window")
    b = with_income_ranking(df, ["key"], desc, "value", strategy="split", max_rows_per_key=100)
    assert _as_set(a, cols) == _as_set(b, cols)

    by_day = OrderSpec("day", tiebreak=["id"])
    a = with_rolling_mean(df, ["key"], by_day, "value", preceding=4, strategy="window")
    b = with_rolling_mean(df, ["key"], by_day, "value", preceding=4, strategy="split", max_rows_per_key=100)
    assert _as_set(a, ["id", "RollingAvg"]) == _as_set(b, ["id", "RollingAvg"])


def _parts(df, keys, order, bound):
    """Rows per (key, part) of the hot keys."""
    split = windows._plan(df, keys, order, "split", bound)
    return split, split.hot.groupBy(*split.group).count()


def test_split_spreads_hot_key(spark):
    df = _skewed_frame(spark)
    split, parts = _parts(df, ["key"], OrderSpec("value", tiebreak=["id"]), 100)
    assert parts.where("key = 'hot'").count() >= 8
    assert parts.agg(F.max("count")).first()[0] < 200  # the hot key alone has ~1050 rows
    assert split.cold.where("key = 'hot'").isEmpty()


def test_choose_strategy(spark):
    df = _skewed_frame(spark)
    assert choose_strategy(df, ["key"], max_rows_per_key=500) == "split"
    assert choose_strategy(df, ["key"], max_rows_per_key=5000) == "window"


def test_group_aggregate_matches_window_and_keeps_null_keys(spark):
    df = _skewed_frame(spark)
    got = with_group_aggregate(df, ["key"], F.count("id"), "n")
    want = df.withColumn("n", F.count("id").over(Window.partitionBy("key")))
    assert _as_set(got, ["id", "n"]) == _as_set(want, ["id", "n"])


def test_same_key_windows_share_one_exchange(products_df):
    out = with_rank_columns(products_df, ["category"], OrderSpec("revenue", tiebreak=["product"]), "revenue",
                            strategy="window")
    assert count_nodes(out, "Exchange") == 1


def _copies_frame(spark, n=3000, seed=11):
    """One key holds ~40% of rows and ~2/3 of those share one value (copies)."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        r = rnd.random()
        if r < 0.4:
            key = "hot"
            value = 10.0 if rnd.random() < 0.67 else float(rnd.randint(0, 40))
        else:
            key = None if r < 0.43 else f"k{rnd.randint(0, 30)}"
            value = None if rnd.random() < 0.05 else float(rnd.randint(0, 40))
        rows.append((i, key, value))
    return spark.createDataFrame(rows, "id long, key string, value double")


def test_heavy_tie_group_is_split_and_exact(spark):
    df = _copies_frame(spark)
    order = OrderSpec("value", tiebreak=["id"])
    split, parts = _parts(df, ["key"], order, 100)
    copies = split.hot.where((F.col("key") == "hot") & (F.col("value") == 10.0))
    assert copies.select(split.group[-1]).distinct().count() >= 8
    assert parts.agg(F.max("count")).first()[0] < 200  # the copies alone are ~800 rows; parts aim at 50

    cols = ["id", "prevRevenue", "prev2Revenue", "row_number", "rev_rank", "rev_dense_rank"]
    a = with_rank_columns(df, ["key"], order, "value", strategy="window")
    b = with_rank_columns(df, ["key"], order, "value", strategy="split", max_rows_per_key=100)
    assert _as_set(a, cols) == _as_set(b, cols)

    for desc in (False, True):
        o = OrderSpec("value", descending=desc, tiebreak=["id"])
        cols = ["id", "ranked", "windowedSum", "windowedRunningTotal"]
        a = with_income_ranking(df, ["key"], o, "value", strategy="window")
        b = with_income_ranking(df, ["key"], o, "value", strategy="split", max_rows_per_key=100)
        assert _as_set(a, cols) == _as_set(b, cols)

    a = with_rolling_mean(df, ["key"], order, "value", preceding=4, strategy="window")
    b = with_rolling_mean(df, ["key"], order, "value", preceding=4, strategy="split", max_rows_per_key=100)
    assert _as_set(a, ["id", "RollingAvg"]) == _as_set(b, ["id", "RollingAvg"])


def test_nan_and_infinities_keep_order_in_split_plan(spark):
    vals = [float("nan"), float("inf"), float("-inf"), None, 1.0, 2.0, 2.0, -3.0] * 40
    df = spark.createDataFrame([(i, "k", v) for i, v in enumerate(vals)], "id long, key string, value double")
    for desc in (False, True):
        o = OrderSpec("value", descending=desc, tiebreak=["id"])
        cols = ["id", "row_number", "rev_rank", "rev_dense_rank"]
        a = with_rank_columns(df, ["key"], o, "value", strategy="window")
        b = with_rank_columns(df, ["key"], o, "value", strategy="split", max_rows_per_key=10)
        assert _as_set(a, cols) == _as_set(b, cols)


def test_string_and_boolean_orders_split_exactly(spark):
    rnd = random.Random(3)
    words = ["", "a", "aa", "ab", "b", "ba", "é", "zz", None]
    rows = [(i, "hot" if i % 3 else "x", rnd.choice(words), rnd.random() < 0.5) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, key string, word string, flag boolean")
    for col in ("word", "flag"):
        for desc in (False, True):
            o = OrderSpec(col, descending=desc, tiebreak=["id"])
            cols = ["id", "row_number", "rev_rank", "rev_dense_rank", "prevRevenue"]
            lags = [(1, None), (2, None)]
            a = with_rank_columns(df, ["key"], o, col, lags=lags, strategy="window")
            b = with_rank_columns(df, ["key"], o, col, lags=lags, strategy="split", max_rows_per_key=20)
            assert _as_set(a, cols) == _as_set(b, cols)


def test_null_ordering_values_as_heavy_group_are_split(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(2400):
        key = "hot" if i % 2 else f"k{i % 7}"
        value = None if (key == "hot" and rnd.random() < 0.6) else float(rnd.randint(0, 500))
        rows.append((i, key, value))
    df = spark.createDataFrame(rows, "id long, key string, value double")
    for desc in (False, True):
        order = OrderSpec("value", descending=desc, tiebreak=["id"])
        split, _ = _parts(df, ["key"], order, 100)
        nulls = split.hot.where((F.col("key") == "hot") & F.col("value").isNull())
        assert nulls.select(split.group[-1]).distinct().count() >= 6  # ~720 NULL rows, ~50 per part
        cols = ["id", "ranked", "windowedSum", "windowedRunningTotal"]
        a = with_income_ranking(df, ["key"], order, "value", strategy="window")
        b = with_income_ranking(df, ["key"], order, "value", strategy="split", max_rows_per_key=100)
        assert _as_set(a, cols) == _as_set(b, cols)
        cols = ["id", "prevRevenue", "prev2Revenue", "row_number", "rev_rank", "rev_dense_rank"]
        a = with_rank_columns(df, ["key"], order, "value", strategy="window")
        b = with_rank_columns(df, ["key"], order, "value", strategy="split", max_rows_per_key=100)
        assert _as_set(a, cols) == _as_set(b, cols)


def test_hot_key_bound_from_session_conf(spark):
    from tessera.operators.windows import MAX_ROWS_CONF, max_rows_per_key_for

    df = _skewed_frame(spark)
    try:
        spark.conf.set(MAX_ROWS_CONF, "500")
        assert max_rows_per_key_for(df) == 500
        assert choose_strategy(df, ["key"]) == "split"
        assert max_rows_per_key_for(df, 7) == 7
    finally:
        spark.conf.unset(MAX_ROWS_CONF)
    assert choose_strategy(df, ["key"]) == "window"


def _both(df, keys, order, value, bound=40, **options):
    """Rows of each operator under the plain and the split plan."""
    for fn, kw in (
        (with_rank_columns, {"lags": [(1, None), (5, None)]}),
        (with_income_ranking, {"scale": options.get("scale")}),
        (with_rolling_mean, {"preceding": 3, "scale": options.get("scale")}),
    ):
        a = fn(df, keys, order, value, strategy="window", **kw)
        b = fn(df, keys, order, value, strategy="split", max_rows_per_key=bound, **kw)
        assert a.columns == b.columns and a.dtypes == b.dtypes
        rows = [sorted((tuple(repr(v) for v in r) for r in x.collect())) for x in (a, b)]
        assert rows[0] == rows[1], fn.__name__


def test_value_other_than_the_order_column(spark):
    rnd = random.Random(4)
    rows = [(i, "hot" if i % 3 else "x", rnd.randint(0, 40), rnd.randint(-500, 500)) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, key string, day int, amount long")
    for descending in (False, True):
        _both(df, ["key"], OrderSpec("day", descending, ["id"]), "amount")
        _both(df.withColumn("day", F.date_add(F.lit("2020-01-01").cast("date"), F.col("day"))), ["key"], OrderSpec("day", descending, ["id"]), "amount")


def test_user_columns_with_underscores_stay(spark):
    rows = [(i, i % 2, i % 7, float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "_1 long, _2 long, __w_x long, _lrn double")
    _both(df, ["_2"], OrderSpec("__w_x", tiebreak=["_1"]), "_lrn", scale=2)


@pytest.mark.parametrize("kind", ["long", "string", "boolean", "decimal(10,2)", "binary"])
def test_heavy_ties_of_any_type(spark, kind):
    """Long texts with a common prefix, and a value that most rows share."""
    rnd = random.Random(6)
    df = spark.createDataFrame([(i, "hot", rnd.choice([1, 1, 1, 1, 0, 2])) for i in range(1200)], "id long, key string, n int")
    value = {"string": F.concat(F.lit("Customer#00000000"), F.col("n")), "boolean": F.col("n") > 0}.get(kind, F.col("n").cast("string" if kind == "binary" else kind).cast(kind))
    df = df.select("id", "key", value.alias("v"), F.concat(F.lit("tie-breaker-"), F.col("id")).alias("name"), F.col("n").alias("amount"))
    order = OrderSpec("v", tiebreak=["name"])
    _, parts = _parts(df, ["key"], order, 100)
    assert parts.agg(F.max("count")).first()[0] < 200
    _both(df, ["key"], order, "amount", bound=100)


def test_times_without_zone_across_a_clock_change(spark):
    """240 times around a spring clock change of the session's zone."""
    df = spark.range(240).select(
        F.lit("k").alias("key"), "id", (F.col("id") * 37 % 101).alias("amount"),
        F.expr("timestampadd(MINUTE, cast(id * 7 as int), TIMESTAMP_NTZ'2021-03-14 00:00:00')").alias("at"),
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        _both(df, ["key"], OrderSpec("at", tiebreak=["id"]), "amount", bound=20)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_rows_alike_in_every_column(spark):
    df = spark.createDataFrame([("k", 1, 2.0)] * 300 + [("k", 2, 1.0)] * 100, "key string, day int, amount double")
    _both(df, ["key"], OrderSpec("day"), "amount", bound=30, scale=2)


def test_several_keys_with_nulls(spark):
    rows = [(i, None if i % 5 == 0 else "a", i % 2 if i % 7 else None, i % 11, float(i % 13)) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, k1 string, k2 int, day int, amount double")
    _both(df, ["k1", "k2"], OrderSpec("day", tiebreak=["id"]), "amount", scale=2)


def test_plain_means_are_not_rounded(spark):
    df = spark.createDataFrame([(1, i, 0.004) for i in range(50)] + [(2, 0, 1e17), (2, 1, 1e17)], "k long, t long, v double")
    for strategy in ("window", "split"):
        got = with_rolling_mean(df, ["k"], OrderSpec("t"), "v", preceding=1, strategy=strategy, max_rows_per_key=10).collect()
        assert all(abs(r.RollingAvg - r.v) < 1e-9 * r.v for r in got)


def test_thousands_of_hot_keys_share_few_parts(spark):
    """6,251 hot keys of 13 rows and one of 3,000: the parts have a ceiling, no (key, part) group grows, results stay."""
    df = spark.range(6251 * 13 + 3000).select(
        "id", F.when(F.col("id") < 6251 * 13, F.col("id") % 6251).otherwise(-1).alias("key"), (F.col("id") * 7919 % 1013).alias("v")
    )
    order = OrderSpec("v", tiebreak=["id"])
    split, parts = _parts(df, ["key"], order, 10)
    ceiling = windows.PARTS_PER_SHUFFLE_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert split.hot.rdd.getNumPartitions() <= ceiling
    assert split.hot.select(split.part).distinct().count() <= ceiling
    in_part = split.hot.groupBy(split.part).count().agg(F.max("count")).first()[0]
    assert in_part < 3 * split.hot.count() / ceiling  # parts are even, so a (key, part) group is bounded too
    assert parts.agg(F.max("count")).first()[0] <= in_part
    cols = ["id", "prevRevenue", "prev2Revenue", "row_number", "rev_rank", "rev_dense_rank"]
    a = with_rank_columns(df, ["key"], order, "v", strategy="window").select(*cols)
    b = with_rank_columns(df, ["key"], order, "v", strategy="split", max_rows_per_key=10).select(*cols)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_part_count_follows_rows_up_to_the_ceiling(spark):
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert windows.part_count(spark, 0, 100) == 1 and windows.part_count(spark, 1000, 1000) == 2
    assert windows.part_count(spark, 10**12, 10) == windows.PARTS_PER_SHUFFLE_PARTITION * width


def test_one_exchange_and_one_sort_serve_all_windows_of_the_parts(spark):
    df = _skewed_frame(spark)
    split = windows._plan(df, ["key"], OrderSpec("value", tiebreak=["id"]), "split", 100)
    rows = split.rows(carry=True)
    w = split.in_order()
    out = rows.withColumns({"a": F.lag("value").over(w), "b": F.row_number().over(split.in_order(own=True)), "c": F.rank().over(split.by_value())})
    assert count_nodes(out, "Exchange hashpartitioning(key") == 1
    assert count_nodes(out, "Sort [key") == 1


def test_sql_text_over_ordered_parts(spark):
    """Rolling means, ranks, ties and a running total in SQL text equal the plain windows, and no group exceeds the bound."""
    df = _copies_frame(spark)
    order = OrderSpec("value", tiebreak=["id"])
    parts = windows.ordered_parts(df, ["key"], order, F.col("value"), reach=4, max_rows_per_key=200)
    groups = parts.groupBy("key", "w_part").agg(F.count_if("w_own").alias("own"), F.count_if(~F.col("w_own")).alias("copies"))
    most = groups.agg(F.max("own").alias("own"), F.max("copies").alias("copies")).first()
    assert most["own"] <= 200 and most["copies"] == 4  # the hot key has about 1,200 rows
    got = spark.sql(
        """
        SELECT id, mean, n, r, d, total FROM (
          SELECT id, w_own, avg(value) OVER w AS mean, w_rows_before + row_number() OVER own AS n,
                 w_rows_before + rank() OVER ties - IF(rank() OVER ties = 1, w_tied_before, 0) AS r,
                 w_values_before + dense_rank() OVER ties AS d,
                 coalesce(w_sum_before, 0) + coalesce(sum(value) OVER ties, 0) + IF(struct(value AS o) <=> w_last, coalesce(w_sum_after, 0), 0) AS total
          FROM {parts}
          WINDOW w AS (PARTITION BY key, w_part ORDER BY w_own, value, id, w_tie ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
                 own AS (PARTITION BY key, w_part, w_own ORDER BY value, id, w_tie), ties AS (PARTITION BY key, w_part, w_own ORDER BY value))
        WHERE w_own""",
        parts=parts,
    )
    want = spark.sql(
        """
        SELECT id, avg(value) OVER (PARTITION BY key ORDER BY value, id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS mean,
               row_number() OVER (PARTITION BY key ORDER BY value, id) AS n, rank() OVER v AS r, dense_rank() OVER v AS d,
               coalesce(sum(value) OVER v, 0) AS total
        FROM {df} WINDOW v AS (PARTITION BY key ORDER BY value)""",
        df=df,
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_ordered_parts_refuses_columns_under_its_prefix(spark):
    df = spark.createDataFrame([(1, 2)], "w_part int, k int")
    with pytest.raises(ValueError, match="prefix"):
        windows.ordered_parts(df, ["k"], OrderSpec("w_part"))
    assert "x_part" in windows.ordered_parts(df, ["k"], OrderSpec("w_part"), prefix="x_").columns
