"""The reference's datasets, expressed over the driver's tables.

Each function returns a lazy DataFrame with the reference's column names, so
one operator serves both shapes.  Mapping:

* account finances  = ``orders``  (AccountNumber, Amount, Date, Description)
* transactions      = ``lineitem`` (txn_id, amount, cust_id, status, merchant_id, times)
* order charges     = ``lineitem`` (Boro, Zip, OMOCreateDate)
* products          = ``part``    (product, category, revenue)
* employees / roles = ``customer`` / one row per ``events.user_id``
* demographics      = ``customer`` + ``nation`` (country, course id)
* finance flags     = ``orders``  (has_debt, has_financial_dependents, has_student_loans, income)
* courses           = ``nation``
* companies         = ``conversations`` (company, employees[turn, role])
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.aggregates import first_by
from tessera.operators.joins import broadcast_if_small
from tessera.tables import table

# Fixed values used to derive the stand-ins.
SWITZERLAND = "NATION_5"
DEBT_STATUS = "F"
DEPENDENTS_PRIORITY = "1-URGENT"
LOANS_INCOME_OVER = 250000
MOVIES = "1-URGENT"
EXCLUDED_SEGMENT = "HOUSEHOLD"
# Dimension tables broadcast only under this many rows.
DIMENSION_ROWS = 100_000


def finances(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("TxnId"),
        F.col("o_custkey").alias("AccountNumber"),
        F.col("o_totalprice").alias("Amount"),
        F.col("o_orderdate").alias("Date"),
        F.col("o_orderpriority").alias("Description"),
    )


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("txn_id"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("created_time_str"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_partkey").alias("cust_id"),
        F.col("l_linenumber").alias("status"),
        F.col("l_suppkey").alias("merchant_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("created_time_ist"),
    )


def products(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return p.select(
        "p_partkey",
        F.col("p_name").alias("product"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("revenue"),
    )


def employees(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("firstName"),
        F.col("c_mktsegment").alias("lastName"),
    )


def office_employees(spark: SparkSession, sf: str) -> DataFrame:
    """Employees outside one segment, so that some roles have no employee (right and full joins)."""
    return employees(spark, sf).filter(F.col("lastName") != EXCLUDED_SEGMENT)


def roles(spark: SparkSession, sf: str) -> DataFrame:
    """One row per event user: the type of the user's first event is the role."""
    e = table(spark, sf, "events")
    return first_by(e, F.col("user_id").alias("id"), "event_type", ["ts", "event_id"], "jobRole")


def demographics(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    joined = c.join(broadcast_if_small(n, DIMENSION_ROWS), c["c_nationkey"] == n["n_nationkey"], "inner")
    return joined.select(
        F.col("c_custkey").alias("id"),
        "country",
        (F.col("c_acctbal") < 0).alias("negative_balance"),
        F.col("c_nationkey").alias("course_id"),
    )


def finance_flags(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderkey").alias("finance_id"),
        (F.col("o_orderstatus") == DEBT_STATUS).alias("has_debt"),
        (F.col("o_orderpriority") == DEPENDENTS_PRIORITY).alias("has_financial_dependents"),
        (F.col("o_totalprice") > LOANS_INCOME_OVER).alias("has_student_loans"),
        F.col("o_totalprice").alias("income"),
    )


def courses(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")
    return n.select(F.col("n_nationkey").alias("course_id"), F.col("n_name").alias("course_name"))
