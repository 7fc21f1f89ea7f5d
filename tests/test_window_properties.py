"""Property test: the split plan equals the plain window plan on random data."""

from __future__ import annotations

import os
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators.windows import OrderSpec, with_income_ranking, with_rank_columns, with_rolling_mean

ROW = st.tuples(
    st.sampled_from(["hot", "hot", "hot", "a", "b", None]),
    st.one_of(st.none(), st.integers(min_value=-3, max_value=6).map(float)),
)


@settings(max_examples=int(os.environ.get("WINDOW_PROPERTY_EXAMPLES", "6")), deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, min_size=1, max_size=120), desc=st.booleans(), bound=st.integers(min_value=1, max_value=20))
def test_split_plan_equals_window_plan(spark, rows, desc, bound):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "id long, key string, value double")
    order = OrderSpec("value", descending=desc, tiebreak=["id"])

    def same(fn, cols, **kw):
        a = fn(df, ["key"], order, "value", strategy="window", **kw)
        b = fn(df, ["key"], order, "value", strategy="split", max_rows_per_key=bound, **kw)
        assert Counter(tuple(r) for r in a.select(*cols).collect()) == Counter(
            tuple(r) for r in b.select(*cols).collect()
        )

    same(with_rank_columns, ["id", "prevRevenue", "prev2Revenue", "row_number", "rev_rank", "rev_dense_rank"])
    same(with_income_ranking, ["id", "ranked", "windowedSum", "windowedRunningTotal"])
    same(with_rolling_mean, ["id", "RollingAvg"], preceding=2)
