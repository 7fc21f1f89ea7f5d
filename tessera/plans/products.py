"""Product revenue ranking per category (``part``: category = ``p_type``,
revenue = ``p_retailprice``): lag, lag with default, row_number, rank,
dense_rank over one named ordering, in the DSL and in SQL.

``p_type`` has only six values, so at scale each category is a sixth of the
table: the automatic plan switches to the split window for hot categories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.windows import OrderSpec, ordered_parts, with_rank_columns
from tessera.plans.registry import register
from tessera.plans.standins import products

_PRODUCTS_SQL = """
    SELECT p_partkey, p_name AS product, p_type AS category, p_retailprice AS revenue,
           lag(p_retailprice, 1) OVER w AS prevRevenue,
           lag(p_retailprice, 2, 0) OVER w AS prev2Revenue,
           CAST(row_number() OVER w AS BIGINT) AS row_number,
           CAST(rank() OVER v AS BIGINT) AS rev_rank,
           CAST(dense_rank() OVER v AS BIGINT) AS rev_dense_rank
    FROM part
    WINDOW w AS (PARTITION BY p_type ORDER BY p_retailprice, p_partkey),
           v AS (PARTITION BY p_type ORDER BY p_retailprice)
"""

# Ties on revenue are broken by the part key for row numbers and lags.
CATEGORY_REVENUE = OrderSpec("revenue", tiebreak=["p_partkey"])


def _windows(spark: SparkSession, sf: str, strategy: str, max_rows_per_key: int | None = None) -> DataFrame:
    return with_rank_columns(
        products(spark, sf), ["category"], CATEGORY_REVENUE, "revenue", strategy=strategy, max_rows_per_key=max_rows_per_key
    )


@register("product_windows", _PRODUCTS_SQL)
def product_windows(spark: SparkSession, sf: str) -> DataFrame:
    return _windows(spark, sf, "auto")


@register("product_windows_split", _PRODUCTS_SQL)
def product_windows_split(spark: SparkSession, sf: str) -> DataFrame:
    """The hot-category plan forced on (every category split by revenue range)."""
    return _windows(spark, sf, "split", max_rows_per_key=200)


@register("product_windows_sql", _PRODUCTS_SQL)
def product_windows_sql(spark: SparkSession, sf: str) -> DataFrame:
    """SQL text keeps Spark's plain window plan: each category in one task.  Where
    categories are large, write it over ordered parts (``product_windows_sql_split``)."""
    return spark.sql(
        """
        SELECT p_partkey, product, category, revenue,
               lag(revenue, 1) OVER w AS prevRevenue,
               lag(revenue, 2, 0) OVER w AS prev2Revenue,
               CAST(row_number() OVER w AS BIGINT) AS row_number,
               CAST(rank() OVER v AS BIGINT) AS rev_rank,
               CAST(dense_rank() OVER v AS BIGINT) AS rev_dense_rank
        FROM {products}
        WINDOW w AS (PARTITION BY category ORDER BY revenue, p_partkey),
               v AS (PARTITION BY category ORDER BY revenue)
        """,
        products=products(spark, sf),
    )


@register("product_windows_sql_split", _PRODUCTS_SQL)
def product_windows_sql_split(spark: SparkSession, sf: str) -> DataFrame:
    """SQL windows per (category, part): ``lag`` sees copies of the 2 rows before a part,
    ranks run over a part's own rows and add what earlier parts hold."""
    parts = ordered_parts(products(spark, sf), ["category"], CATEGORY_REVENUE, reach=2, max_rows_per_key=200)
    return spark.sql(
        """
        SELECT p_partkey, product, category, revenue, prevRevenue, prev2Revenue, row_number,
               first_rank - IF(first_rank = w_rows_before + 1, w_tied_before, 0) AS rev_rank, rev_dense_rank
        FROM (SELECT *,
                     lag(revenue, 1) OVER w AS prevRevenue,
                     lag(revenue, 2, 0) OVER w AS prev2Revenue,
                     w_rows_before + row_number() OVER own AS row_number,
                     w_rows_before + rank() OVER ties AS first_rank,
                     w_values_before + dense_rank() OVER ties AS rev_dense_rank
              FROM {parts}
              WINDOW w AS (PARTITION BY category, w_part ORDER BY w_own, revenue, p_partkey, w_tie),
                     own AS (PARTITION BY category, w_part, w_own ORDER BY revenue, p_partkey, w_tie),
                     ties AS (PARTITION BY category, w_part, w_own ORDER BY revenue))
        WHERE w_own
        """,
        parts=parts,
    )
