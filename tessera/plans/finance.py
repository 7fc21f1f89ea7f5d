"""Account-finance queries (scans, account summary, arrays, views, sorting,
rolling average, CASE tiers) over the ``orders`` stand-in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.arrays import array_profile
from tessera.operators import aggregates as agg
from tessera.operators import sorting
from tessera.operators.windows import OrderSpec, ordered_parts, with_income_ranking, with_rank_columns, with_rolling_mean
from tessera.plans.registry import register
from tessera.plans.standins import MOVIES, finances
from tessera.sinks.files import register_view
from tessera.sources.files import read_parquet, sql_on_file
from tessera.tables import table, table_path

# --- A1, A2, E14, G4 ------------------------------------------------------


@register(
    "scan_parquet",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return read_parquet(spark, table_path(sf, "orders"), cols)


@register("sql_on_file", "SELECT * FROM orders")
def sql_file(spark: SparkSession, sf: str) -> DataFrame:
    return sql_on_file(spark, table_path(sf, "orders"))


@register("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return agg.row_count(table(spark, sf, "lineitem"))


@register("preview_limit", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def preview_limit(spark: SparkSession, sf: str) -> DataFrame:
    return sorting.preview(table(spark, sf, "orders"), ["o_orderkey"], 5)


# --- C1, C2, I1 -----------------------------------------------------------


@register(
    "project_basic",
    """
    SELECT o_orderkey, o_custkey, o_totalprice,
           CAST(year(o_orderdate) AS INTEGER) AS order_year,
           o_totalprice / 1000.0 AS price_thousands,
           lower(o_orderpriority) AS o_orderpriority
    FROM orders
    """,
)
def project_basic(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", o["o_custkey"], "o_totalprice", "o_orderdate", "o_orderpriority").withColumns(
        {
            "order_year": F.year("o_orderdate"),
            "price_thousands": F.col("o_totalprice") / F.lit(1000.0),
            "o_orderpriority": F.lower("o_orderpriority"),
        }
    ).drop("o_orderdate")


@register(
    "concat_details",
    """
    SELECT o_orderkey, concat_ws(' - ', CAST(o_custkey AS VARCHAR), o_orderpriority) AS AccountDetails
    FROM orders
    """,
)
def concat_details(spark: SparkSession, sf: str) -> DataFrame:
    f = finances(spark, sf)
    return f.select(
        F.col("TxnId").alias("o_orderkey"),
        F.concat_ws(" - ", "AccountNumber", "Description").alias("AccountDetails"),
    )


# --- G1, G2, C20, B7 ------------------------------------------------------


@register(
    "top_k_desc",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
)
def top_k_desc(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sorting.top_k(o, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 5)


_FIN_SQL = """
    SELECT o_orderkey AS TxnId, o_custkey AS AccountNumber, o_totalprice AS Amount,
           o_orderdate AS "Date", o_orderpriority AS Description
    FROM orders
"""


@register(
    "sql_order_by",
    f"SELECT * FROM ({_FIN_SQL}) f ORDER BY Amount ASC NULLS FIRST, TxnId LIMIT 5",
)
def sql_order_by(spark: SparkSession, sf: str) -> DataFrame:
    # Column names in Spark SQL are case-insensitive: ``amount`` is ``Amount``.
    return spark.sql("SELECT * FROM {fin} ORDER BY amount ASC NULLS FIRST, TxnId LIMIT 5", fin=finances(spark, sf))


# --- E1-E3, I9-I11, M1 ----------------------------------------------------

_SET_TEXT = "array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',')"
_EXACT_TOTAL = "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)"


@register(
    "account_summary",
    f"""
    SELECT o_custkey AS AccountNumber,
           {_EXACT_TOTAL} / count(o_totalprice) AS AverageTransaction,
           {_EXACT_TOTAL} AS TotalTransaction,
           count(o_totalprice) AS NumberOfTransaction,
           max(o_totalprice) AS MaxTransaction,
           min(o_totalprice) AS MinTransaction,
           {_SET_TEXT} AS UniqueTransactionDescriptions
    FROM orders GROUP BY o_custkey
    """,
)
def account_summary(spark: SparkSession, sf: str) -> DataFrame:
    # Money: exact sums at two decimals, asked for here.
    return agg.summarize_by_key(finances(spark, sf), "AccountNumber", "Amount", "Description", scale=2)


@register(
    "account_summary_sql",
    f"""
    SELECT o_custkey AS AccountNumber,
           {_EXACT_TOTAL} AS TotalTransaction,
           count(o_totalprice) AS NumberOfTransaction,
           max(o_totalprice) AS MaxTransaction,
           min(o_totalprice) AS MinTransaction,
           {_SET_TEXT} AS UniqueTransactionDescriptions
    FROM orders GROUP BY o_custkey
    """,
)
def account_summary_sql(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """
        SELECT AccountNumber,
               CAST(sum(CAST(Amount AS DECIMAL(18,2))) AS DOUBLE) AS TotalTransaction,
               count(Amount) AS NumberOfTransaction,
               max(Amount) AS MaxTransaction,
               min(Amount) AS MinTransaction,
               array_join(array_sort(collect_set(Description)), ',') AS UniqueTransactionDescriptions
        FROM {fin}
        GROUP BY AccountNumber
        """,
        fin=finances(spark, sf),
    )


_ARRAYS_SQL = f"""
    SELECT o_custkey AS AccountNumber,
           {_SET_TEXT} AS UniqueTransactionDescriptions,
           CAST(count(DISTINCT o_orderpriority) AS BIGINT) AS CountOfUniqueTransactionTypes,
           array_to_string(list_reverse_sort(list(DISTINCT o_orderpriority)), ',')
               AS OrderedUniqueTransactionDescriptions,
           bool_or(o_orderpriority = '{MOVIES}') AS WentToMovies
    FROM orders GROUP BY o_custkey
"""


@register("account_arrays", _ARRAYS_SQL)
def account_arrays(spark: SparkSession, sf: str) -> DataFrame:
    summary = agg.summarize_by_key(finances(spark, sf), "AccountNumber", "Amount", "Description", set_as_text=False)
    return summary.select(
        "AccountNumber",
        F.array_join(F.array_sort("UniqueTransactionDescriptions"), ",").alias("UniqueTransactionDescriptions"),
        *array_profile("UniqueTransactionDescriptions", MOVIES),
    )


@register("sql_view_chain", _ARRAYS_SQL)
def sql_view_chain(spark: SparkSession, sf: str) -> DataFrame:
    """A view on a view: finances -> agg_finances -> the array report, in SQL.

    Registering views is the feature here, so they carry this library's name.
    """
    register_view(finances(spark, sf), "tessera_finances")
    register_view(
        spark.sql(
            """
            SELECT AccountNumber, collect_set(Description) AS UniqueTransactionDescriptions
            FROM tessera_finances GROUP BY AccountNumber
            """
        ),
        "tessera_agg_finances",
    )
    return spark.sql(
        f"""
        SELECT AccountNumber,
               array_join(array_sort(UniqueTransactionDescriptions), ',') AS UniqueTransactionDescriptions,
               CAST(size(UniqueTransactionDescriptions) AS BIGINT) AS CountOfUniqueTransactionTypes,
               array_join(sort_array(UniqueTransactionDescriptions, false), ',')
                   AS OrderedUniqueTransactionDescriptions,
               array_contains(UniqueTransactionDescriptions, '{MOVIES}') AS WentToMovies
        FROM tessera_agg_finances
        """
    )


# --- F1, F2, I14, I15, M3 -------------------------------------------------

_ROLLING_SQL = """
    SELECT o_orderkey AS TxnId, o_custkey AS AccountNumber, o_totalprice AS Amount,
           CAST(o_orderdate AS DATE) AS "Date", o_orderpriority AS Description,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE)
               / count(o_totalprice) OVER w AS RollingAvg
    FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                 ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
"""


BY_DATE = OrderSpec("Date", tiebreak=["TxnId"])


def _rolling(spark: SparkSession, sf: str, strategy: str, max_rows_per_key: int | None = None) -> DataFrame:
    f = finances(spark, sf).withColumn("Date", F.to_date("Date"))
    return with_rolling_mean(
        f, ["AccountNumber"], BY_DATE, "Amount", preceding=4, scale=2, strategy=strategy, max_rows_per_key=max_rows_per_key
    )


@register("rolling_avg", _ROLLING_SQL)
def rolling_avg(spark: SparkSession, sf: str) -> DataFrame:
    return _rolling(spark, sf, "auto")


@register("rolling_avg_split", _ROLLING_SQL)
def rolling_avg_split(spark: SparkSession, sf: str) -> DataFrame:
    """The hot-key plan forced on: accounts with more than 10 orders are split
    into ordered parts, the rest take the ordinary path; checked against
    the same oracle."""
    return _rolling(spark, sf, "split", max_rows_per_key=10)


@register("rolling_avg_sql", _ROLLING_SQL)
def rolling_avg_sql(spark: SparkSession, sf: str) -> DataFrame:
    """Text dates parsed in SQL, then the window in SQL (``0 following`` = current row).

    SQL text keeps Spark's plain window plan; where accounts may be hot, write
    it over ordered parts (``rolling_avg_sql_split``).
    """
    raw = finances(spark, sf).withColumn("Date", F.date_format("Date", "MM/dd/yyyy"))
    dated = spark.sql(
        """
        SELECT TxnId, AccountNumber, Amount,
               CAST(try_to_timestamp(Date, 'M/d/yyyy') AS DATE) AS Date, Description
        FROM {raw}
        """,
        raw=raw,
    )
    return spark.sql(
        """
        SELECT TxnId, AccountNumber, Amount, Date, Description,
               CAST(sum(CAST(Amount AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(Amount) OVER w AS RollingAvg
        FROM {dated}
        WINDOW w AS (PARTITION BY AccountNumber ORDER BY Date, TxnId
                     ROWS BETWEEN 4 PRECEDING AND 0 FOLLOWING)
        """,
        dated=dated,
    )


@register("rolling_avg_sql_split", _ROLLING_SQL)
def rolling_avg_sql_split(spark: SparkSession, sf: str) -> DataFrame:
    """The same SQL window over a view of ordered parts: accounts of more than 10
    orders are cut, and each part has copies of the 4 rows before it."""
    f = finances(spark, sf).withColumn("Date", F.to_date("Date"))
    parts = ordered_parts(f, ["AccountNumber"], BY_DATE, reach=4, max_rows_per_key=10)
    return spark.sql(
        """
        SELECT TxnId, AccountNumber, Amount, Date, Description, RollingAvg
        FROM (SELECT *, CAST(sum(CAST(Amount AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(Amount) OVER w AS RollingAvg
              FROM {parts}
              WINDOW w AS (PARTITION BY AccountNumber, w_part ORDER BY w_own, Date, TxnId, w_tie
                           ROWS BETWEEN 4 PRECEDING AND 0 FOLLOWING))
        WHERE w_own
        """,
        parts=parts,
    )


# Windows whose value is not the ordering column: amounts by date.

_RANK_SQL = """
    SELECT o_orderkey AS TxnId, o_custkey AS AccountNumber, o_totalprice AS Amount, o_orderdate AS "Date",
           o_orderpriority AS Description,
           lag(o_totalprice, 1) OVER w AS prevAmount, lag(o_totalprice, 3, 0) OVER w AS prev3Amount,
           CAST(row_number() OVER w AS BIGINT) AS txn_number,
           CAST(rank() OVER v AS BIGINT) AS date_rank, CAST(dense_rank() OVER v AS BIGINT) AS date_dense_rank
    FROM orders
    WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey),
           v AS (PARTITION BY o_orderpriority ORDER BY o_orderdate)
"""


def _rank_by_date(spark: SparkSession, sf: str, **options) -> DataFrame:
    return with_rank_columns(
        finances(spark, sf), ["Description"], BY_DATE, "Amount", lags=[(1, None), (3, 0)], lag_aliases=["prevAmount", "prev3Amount"],
        row_number_alias="txn_number", rank_alias="date_rank", dense_rank_alias="date_dense_rank", **options,
    )


@register("account_rank_by_date", _RANK_SQL)
def account_rank_by_date(spark: SparkSession, sf: str) -> DataFrame:
    return _rank_by_date(spark, sf)


@register("account_rank_by_date_split", _RANK_SQL)
def account_rank_by_date_split(spark: SparkSession, sf: str) -> DataFrame:
    """The hot-key plan forced on: five priorities, each cut into ordered parts."""
    return _rank_by_date(spark, sf, strategy="split", max_rows_per_key=500)


_RUNNING_SQL = """
    SELECT o_orderkey AS TxnId, o_custkey AS AccountNumber, o_totalprice AS Amount, o_orderdate AS "Date",
           o_orderpriority AS Description,
           CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS txn_number,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_orderpriority) AS DOUBLE) AS total,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate
                RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
    FROM orders
"""


def _running_by_date(spark: SparkSession, sf: str, **options) -> DataFrame:
    return with_income_ranking(
        finances(spark, sf), ["Description"], BY_DATE, "Amount", row_number_alias="txn_number", total_alias="total",
        running_alias="running_total", scale=2, **options,
    )


@register("account_running_by_date", _RUNNING_SQL)
def account_running_by_date(spark: SparkSession, sf: str) -> DataFrame:
    return _running_by_date(spark, sf)


@register("account_running_by_date_split", _RUNNING_SQL)
def account_running_by_date_split(spark: SparkSession, sf: str) -> DataFrame:
    return _running_by_date(spark, sf, strategy="split", max_rows_per_key=500)


@register(
    "net_price_summary",
    """
    SELECT l_suppkey AS AccountNumber,
           round(avg(l_extendedprice * (1 - l_discount)), 4) AS AverageTransaction,
           round(sum(l_extendedprice * (1 - l_discount)), 4) AS TotalTransaction,
           count(*) AS NumberOfTransaction,
           round(max(l_extendedprice * (1 - l_discount)), 4) AS MaxTransaction,
           round(min(l_extendedprice * (1 - l_discount)), 4) AS MinTransaction,
           array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS UniqueTransactionDescriptions
    FROM lineitem GROUP BY l_suppkey
    """,
)
def net_price_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts of four decimals, plain ``avg`` and ``sum``; rounded only for the comparison."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))
    out = agg.summarize_by_key(li, "l_suppkey", "net", "l_returnflag")
    amounts = ["AverageTransaction", "TotalTransaction", "MaxTransaction", "MinTransaction"]
    return out.withColumns({c: F.round(c, 4) for c in amounts})


# --- C16, C17 -------------------------------------------------------------

_TIER_SQL = """
    SELECT *, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Premium'
                   WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Legacy'
                   ELSE 'Standard' END AS Tier
    FROM customer
"""


@register("case_when_tier", _TIER_SQL)
def case_when_tier(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    tier = (
        F.when(F.col("c_mktsegment") == "BUILDING", "Premium")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "Legacy")
        .otherwise("Standard")
    )
    return c.select("*", tier.alias("Tier"))


@register("case_when_tier_sql", _TIER_SQL)
def case_when_tier_sql(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """
        SELECT *,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'Premium'
                    WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Legacy'
                    ELSE 'Standard'
               END AS Tier
        FROM {customers}
        """,
        customers=table(spark, sf, "customer"),
    )
