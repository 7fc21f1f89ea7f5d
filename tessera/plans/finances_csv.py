"""Finance CSV jobs: PERMISSIVE and DROPMALFORMED reads, delimited files,
partitioned CSV round trip, filter on a hidden column, income ranking.

The CSV is staged from ``orders`` with the reference's finance layout
(``id,has_debt,has_financial_dependents,has_student_loans,income``) and with
bad cells derived from the data: status ``P`` writes ``maybe`` as the debt
flag, priority ``5-LOW`` writes ``n/a`` as income, and priority
``4-NOT SPECIFIED`` writes a short line of three fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructType

from tessera.operators.filters import where_sql
from tessera.operators.windows import OrderSpec, with_income_ranking
from tessera.plans.registry import register
from tessera.plans.standins import DEBT_STATUS, DEPENDENTS_PRIORITY, LOANS_INCOME_OVER
from tessera.session import scratch_path, staged
from tessera.sinks.files import write_csv, write_text_lines
from tessera.sources.files import load_new_files, read_csv, read_delimited
from tessera.tables import table

# The finance layout's names and types (id widened to long: order
# keys exceed int at scale).
FIN_SCHEMA = (
    StructType()
    .add("id", LongType(), True)
    .add("has_debt", BooleanType(), True)
    .add("has_financial_dependents", BooleanType(), True)
    .add("has_student_loans", BooleanType(), True)
    .add("income", DoubleType(), True)
)
FIN_NAMES = [f.name for f in FIN_SCHEMA.fields]

# Fixed values that make bad cells.
BAD_FLAG_STATUS = "P"
BAD_INCOME_PRIORITY = "5-LOW"
SHORT_LINE_PRIORITY = "4-NOT SPECIFIED"


def _flag_text(cond) -> F.Column:
    return F.when(cond, F.lit("true")).otherwise(F.lit("false"))


def stage_finance_csv(spark: SparkSession, sf: str) -> str:
    o = table(spark, sf, "orders")
    debt = F.when(F.col("o_orderstatus") == BAD_FLAG_STATUS, F.lit("maybe")).otherwise(
        _flag_text(F.col("o_orderstatus") == DEBT_STATUS)
    )
    deps = _flag_text(F.col("o_orderpriority") == DEPENDENTS_PRIORITY)
    loans = _flag_text(F.col("o_totalprice") > LOANS_INCOME_OVER)
    income = F.when(F.col("o_orderpriority") == BAD_INCOME_PRIORITY, F.lit("n/a")).otherwise(
        F.col("o_totalprice").cast("string")
    )
    key = F.col("o_orderkey").cast("string")
    line = F.when(
        F.col("o_orderpriority") == SHORT_LINE_PRIORITY, F.concat_ws(",", key, debt, deps)
    ).otherwise(F.concat_ws(",", key, debt, deps, loans, income))
    return staged(spark, "finances_csv", lambda path: write_text_lines(o.select(line.alias("value")), path))


def finances_permissive(spark: SparkSession, sf: str) -> DataFrame:
    return read_csv(spark, stage_finance_csv(spark, sf), FIN_SCHEMA, mode="PERMISSIVE", header=False, sep=",")


_PERMISSIVE_SQL = f"""
    SELECT o_orderkey AS id,
           CASE WHEN o_orderstatus = '{BAD_FLAG_STATUS}' THEN NULL
                ELSE o_orderstatus = '{DEBT_STATUS}' END AS has_debt,
           o_orderpriority = '{DEPENDENTS_PRIORITY}' AS has_financial_dependents,
           CASE WHEN o_orderpriority = '{SHORT_LINE_PRIORITY}' THEN NULL
                ELSE o_totalprice > {LOANS_INCOME_OVER} END AS has_student_loans,
           CASE WHEN o_orderpriority IN ('{SHORT_LINE_PRIORITY}', '{BAD_INCOME_PRIORITY}') THEN NULL
                ELSE o_totalprice END AS income
    FROM orders
"""


@register("csv_permissive", _PERMISSIVE_SQL)
def csv_permissive(spark: SparkSession, sf: str) -> DataFrame:
    return finances_permissive(spark, sf)


@register(
    "csv_dropmalformed",
    f"""
    SELECT o_orderkey AS id, o_orderstatus = '{DEBT_STATUS}' AS has_debt,
           o_orderpriority = '{DEPENDENTS_PRIORITY}' AS has_financial_dependents,
           o_totalprice > {LOANS_INCOME_OVER} AS has_student_loans, o_totalprice AS income
    FROM orders
    WHERE o_orderstatus <> '{BAD_FLAG_STATUS}'
      AND o_orderpriority NOT IN ('{SHORT_LINE_PRIORITY}', '{BAD_INCOME_PRIORITY}')
    """,
)
def csv_dropmalformed(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with any bad or missing cell are dropped; columns renamed by position."""
    path = stage_finance_csv(spark, sf)
    return read_csv(spark, path, FIN_SCHEMA, mode="DROPMALFORMED", names=FIN_NAMES)


@register(
    "filter_hidden_column",
    f"""
    SELECT id, income FROM ({_PERMISSIVE_SQL}) f WHERE has_debt = true
    """,
)
def filter_hidden_column(spark: SparkSession, sf: str) -> DataFrame:
    """Projection without ``has_debt``, then a SQL-text filter on it (pushed to the CSV scan)."""
    return where_sql(finances_permissive(spark, sf).select("id", "income", "has_debt"), "has_debt = true").select(
        "id", "income"
    )


_RANKED_SQL = f"""
    SELECT id, has_debt, has_financial_dependents, has_student_loans, income,
           CAST(row_number() OVER (PARTITION BY has_debt ORDER BY income DESC NULLS LAST, id) AS BIGINT) AS ranked,
           CAST(sum(CAST(income AS DECIMAL(18,2))) OVER (PARTITION BY has_debt) AS DOUBLE) AS windowedSum,
           CAST(sum(CAST(income AS DECIMAL(18,2))) OVER (
                PARTITION BY has_debt ORDER BY income DESC NULLS LAST
                RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS windowedRunningTotal
    FROM ({_PERMISSIVE_SQL}) f
"""


def _ranked(spark: SparkSession, sf: str, strategy: str, max_rows_per_key: int | None = None) -> DataFrame:
    return with_income_ranking(
        finances_permissive(spark, sf),
        ["has_debt"],
        OrderSpec("income", descending=True, tiebreak=["id"]),
        "income",
        scale=2,
        strategy=strategy,
        max_rows_per_key=max_rows_per_key,
    )


@register("ranked_income", _RANKED_SQL)
def ranked_income(spark: SparkSession, sf: str) -> DataFrame:
    """Row number, partition total and running total (ties share) per debt flag."""
    return _ranked(spark, sf, "auto")


@register("ranked_income_split", _RANKED_SQL)
def ranked_income_split(spark: SparkSession, sf: str) -> DataFrame:
    """Same, with the hot-key plan forced on: the debt flag has only three
    values, so at scale each flag is a third of the table."""
    return _ranked(spark, sf, "split", max_rows_per_key=1000)


# --- A5, A12, B3 ----------------------------------------------------------

_DELIM_SQL = """
    SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
           CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_extendedprice AS VARCHAR) AS l_extendedprice,
           strftime(l_shipdate, '%Y-%m-%d') AS ship_date, l_returnflag
    FROM lineitem
"""


def _receipts(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"), "l_returnflag",
    )


@register("csv_delimited", _DELIM_SQL)
def csv_delimited(spark: SparkSession, sf: str) -> DataFrame:
    """A landed ``|``-delimited file with header: every column read as text."""
    path = staged(spark, "receipts", lambda p: write_csv(_receipts(spark, sf), p, header=True, sep="|"))
    return read_delimited(spark, path, sep="|", header=True)


@register(
    "csv_roundtrip",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
           CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_extendedprice AS VARCHAR) AS l_extendedprice,
           strftime(l_shipdate, '%Y-%m-%d') AS ship_date, l_returnflag
    FROM lineitem
    """,
)
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """CSV partitioned by a low-cardinality column, ``~`` delimiter, header; read back.

    The partition column comes back last, typed from the directory names.
    """
    path = write_csv(
        _receipts(spark, sf), scratch_path(spark, "receipts_by_flag"), header=True, sep="~",
        partition_cols=["l_returnflag"],
    )
    return read_delimited(spark, path, sep="~", header=True)


@register(
    "csv_dropmalformed_inferred",
    f"""
    SELECT CAST(o_orderkey AS INTEGER) AS id,
           CASE WHEN o_orderstatus = '{BAD_FLAG_STATUS}' THEN 'maybe'
                WHEN o_orderstatus = '{DEBT_STATUS}' THEN 'true' ELSE 'false' END AS has_debt,
           o_orderpriority = '{DEPENDENTS_PRIORITY}' AS has_financial_dependents,
           o_totalprice > {LOANS_INCOME_OVER} AS has_student_loans,
           CASE WHEN o_orderpriority = '{BAD_INCOME_PRIORITY}' THEN 'n/a'
                ELSE CAST(o_totalprice AS VARCHAR) END AS income
    FROM orders
    WHERE o_orderpriority <> '{SHORT_LINE_PRIORITY}'
    """,
)
def csv_dropmalformed_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """Types inferred from the data (one extra pass): columns holding ``maybe``
    or ``n/a`` become text, so only the short lines are malformed."""
    path = stage_finance_csv(spark, sf)
    return read_csv(spark, path, None, mode="DROPMALFORMED", infer_schema=True, names=FIN_NAMES)


@register("drop_folder_incremental", _DELIM_SQL)
def drop_folder_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two landings and three loads (the last finds nothing new): every row is taken once."""
    folder, taken, ledger = (scratch_path(spark, name) for name in ("drop_folder", "drop_taken", "drop_ledger"))
    receipts = _receipts(spark, sf).select("*", (F.col("l_orderkey") % 3 == 0).alias("late"))
    schema = ", ".join(f"{c} string" for c in receipts.columns if c != "late")
    for late in (False, True):
        write_csv(receipts.where(F.col("late") == late).drop("late"), folder, header=True, sep="|", mode="append")
        load_new_files(spark, folder, taken, ledger, schema)
    return load_new_files(spark, folder, taken, ledger, schema)
