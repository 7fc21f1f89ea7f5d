"""The composite jobs as queries over the driver's tables (one key per job, or per result that matters)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import jobs, standins
from tessera.operators.nested import nest_children
from tessera.plans.charges import PRUNE_PRICE, PRUNE_YEAR, order_charges, pruned_orders
from tessera.plans.finances_csv import _PERMISSIVE_SQL, _RANKED_SQL, FIN_NAMES, FIN_SCHEMA, stage_finance_csv
from tessera.plans.products import _PRODUCTS_SQL
from tessera.plans.registry import register
from tessera.plans.scholarship import _RECIPIENTS_SQL
from tessera.plans.standins import MOVIES, SWITZERLAND, finances, products
from tessera.plans.transactions import load_transactions, stage_transaction_text
from tessera.session import scratch_path, staged
from tessera.sources.files import read_json
from tessera.tables import table


@register(
    "job_account_report",
    f"""
    SELECT o_custkey AS AccountNumber,
           CAST(count(DISTINCT o_orderpriority) AS BIGINT) AS CountOfUniqueTransactionTypes,
           array_to_string(list_reverse_sort(list(DISTINCT o_orderpriority)), ',') AS OrderedUniqueTransactionDescriptions,
           bool_or(o_orderpriority = '{MOVIES}') AS WentToMovies
    FROM orders GROUP BY o_custkey
    """,
)
def job_account_report(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.account_report(finances(spark, sf), movies_label=MOVIES, scale=2)["arrays"].drop("UniqueTransactionDescriptions")


@register(
    "job_account_top5",
    """
    SELECT o_orderkey AS TxnId, o_custkey AS AccountNumber, o_totalprice AS Amount, o_orderdate AS "Date", o_orderpriority AS Description
    FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5
    """,
)
def job_account_top5(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.account_report(finances(spark, sf))["top5"]


@register(
    "job_rolling_accounts",
    """
    SELECT o_orderkey AS TxnId, o_custkey AS AccountNumber, o_totalprice AS Amount, CAST(o_orderdate AS DATE) AS "Date",
           o_orderpriority AS Description,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(o_totalprice) OVER w AS RollingAvg
    FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
    """,
)
def job_rolling_accounts(spark: SparkSession, sf: str) -> DataFrame:
    raw = finances(spark, sf).withColumn("Date", F.date_format("Date", "M/d/yyyy"))
    return jobs.rolling_accounts(raw, scale=2)


@register("job_product_ranking", _PRODUCTS_SQL)
def job_product_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.product_ranking(products(spark, sf), tiebreak="p_partkey")


@register(
    "job_charge_profile",
    """
    SELECT l_orderkey, l_linenumber, l_returnflag AS Boro, CAST(l_suppkey AS VARCHAR) AS Zip, l_shipdate AS OMOCreateDate,
           l_orderkey AS OMOID, count(l_orderkey) OVER (PARTITION BY l_shipdate) AS OMODailyFreq
    FROM lineitem
    """,
)
def job_charge_profile(spark: SparkSession, sf: str) -> DataFrame:
    charges = order_charges(spark, sf).withColumn("OMOID", F.col("l_orderkey")).drop("l_quantity", "l_extendedprice")
    return jobs.order_charge_profile(charges)["daily"]


@register(
    "job_transaction_totals",
    """
    SELECT l_suppkey AS merchant_id, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
           count(DISTINCT l_linenumber) AS dist_status_count
    FROM lineitem GROUP BY l_suppkey
    """,
)
def job_transaction_totals(spark: SparkSession, sf: str) -> DataFrame:
    fields = load_transactions(spark, stage_transaction_text(spark, sf))
    return jobs.transaction_load(fields, scale=2)["totals"]


@register(
    "job_scholarship",
    f"SELECT r.*, cn.n_name AS course_name FROM ({_RECIPIENTS_SQL}) r JOIN nation cn ON r.course_id = cn.n_nationkey",
)
def job_scholarship(spark: SparkSession, sf: str) -> DataFrame:
    found = jobs.scholarship_recipients(
        standins.demographics(spark, sf), standins.finance_flags(spark, sf), standins.courses(spark, sf), SWITZERLAND
    )
    return found["with_course"]


# People = customers: the first name is the segment in one of three untidy
# forms, the job the name's last digit, the weight the balance where positive.
_PERSON_SQL = """
    SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN upper(c_mktsegment) WHEN 1 THEN ' ' || c_mktsegment ELSE c_mktsegment || ' ' END AS firstName,
           c_name AS lastName, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS weightInLbs,
           CASE c_custkey % 4 WHEN 0 THEN 'Crane Operator' WHEN 1 THEN 'Gardener' WHEN 2 THEN 'Optician' END AS jobType
    FROM customer
"""


def _persons(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    form, job, segment = F.col("c_custkey") % 3, F.col("c_custkey") % 4, F.col("c_mktsegment")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.when(form == 0, F.upper(segment)).when(form == 1, F.concat(F.lit(" "), segment)).otherwise(F.concat(segment, F.lit(" "))).alias("firstName"),
        F.col("c_name").alias("lastName"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("weightInLbs"),
        F.when(job == 0, "Crane Operator").when(job == 1, "Gardener").when(job == 2, "Optician").alias("jobType"),
    )


def _cleaned(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return jobs.people_cleaning(_persons(spark, sf), order=["id"], needle="operator", listed=["Crane Operator", "Gardener"])


@register(
    "job_people_first",
    f"""
    SELECT trim(lower(firstName)) AS name_key, arg_min_null(weightInLbs, id) AS first_weight,
           arg_min(weightInLbs, id) FILTER (WHERE weightInLbs IS NOT NULL) AS first_known_weight
    FROM ({_PERSON_SQL}) p GROUP BY 1
    """,
)
def job_people_first(spark: SparkSession, sf: str) -> DataFrame:
    out = _cleaned(spark, sf)
    return out["first"].join(out["first_non_null"].withColumnRenamed("first_weight", "first_known_weight"), "name_key")


_CLEAN_SQL = f"""
    SELECT id, upper(substring(trim(firstName), 1, 1)) || lower(substring(trim(firstName), 2)) AS firstName,
           lastName, upper(substring(trim(firstName), 1, 1)) || lower(substring(trim(firstName), 2)) || ' ' || lastName AS fullName,
           coalesce(weightInLbs, 0.0) AS weightInLbs, jobType
    FROM ({_PERSON_SQL}) p
"""


@register(
    "job_people_clean",
    f"{_CLEAN_SQL} WHERE lower(jobType) NOT IN ('crane operator', 'gardener')",
)
def job_people_clean(spark: SparkSession, sf: str) -> DataFrame:
    return _cleaned(spark, sf)["not_listed"]


@register("job_people_matching", f"{_CLEAN_SQL} WHERE contains(lower(jobType), 'operator')")
def job_people_matching(spark: SparkSession, sf: str) -> DataFrame:
    return _cleaned(spark, sf)["matching"]


@register("job_people_listed", f"{_CLEAN_SQL} WHERE lower(jobType) IN ('crane operator', 'gardener')")
def job_people_listed(spark: SparkSession, sf: str) -> DataFrame:
    return _cleaned(spark, sf)["listed"]


# Companies = market segments, employees = their customers.
TIERS = {"FURNITURE": "Premium", "BUILDING": "Legacy"}


@register(
    "job_company_tiers",
    f"""
    SELECT c_mktsegment AS company, c_name AS firstName,
           CASE c_mktsegment {" ".join(f"WHEN '{c}' THEN '{t}'" for c, t in TIERS.items())} ELSE 'Standard' END AS Tier
    FROM customer
    """,
)
def job_company_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """M2 over nested records: a segment's customers are spread over records of 64."""
    c = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("company"), F.col("c_custkey").alias("id"), F.col("c_name").alias("firstName"))
    nested = nest_children(c, "company", "id", ["firstName"], parent_alias="company", array_alias="employees")
    path = staged(spark, "segment_records", lambda p: nested.write.json(p))
    records = read_json(spark, path, "company string, employees array<struct<id long, firstName string>>")
    return jobs.company_tiers(records, TIERS)["tiered"]


@register(
    "job_year_layout",
    f"SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE year(o_orderdate) = {PRUNE_YEAR} AND o_totalprice > {PRUNE_PRICE}",
)
def job_year_layout(spark: SparkSession, sf: str) -> DataFrame:
    """M9: the year layout written by the job, read with a partition and a data filter."""
    return pruned_orders(jobs.year_layout(table(spark, sf, "orders"), "o_orderdate", scratch_path(spark, "job_orders_by_year")))


@register("job_format_ranking", _RANKED_SQL)
def job_format_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """M10: CSV to ORC, then the income ranking per debt flag over the ORC table."""
    out = scratch_path(spark, "job_finances_orc")
    return jobs.csv_to_format_ranking(stage_finance_csv(spark, sf), FIN_SCHEMA, out, "orc", spark=spark, scale=2)["ranked"]


@register("job_format_filtered", f"SELECT id, income FROM ({_PERMISSIVE_SQL}) f WHERE has_debt")
def job_format_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """M10: the filter pushed into the ORC scan."""
    out = scratch_path(spark, "job_finances_orc")
    return jobs.csv_to_format_ranking(stage_finance_csv(spark, sf), FIN_SCHEMA, out, "orc", spark=spark)["filtered"]


@register(
    "job_csv_reload",
    f"""
    SELECT 'permissive' AS load, id, has_debt, income FROM ({_PERMISSIVE_SQL}) f
    UNION ALL
    SELECT load, id, has_debt, income FROM ({_PERMISSIVE_SQL}) f, (VALUES ('strict'), ('reread')) AS l(load)
    WHERE has_debt IS NOT NULL AND has_student_loans IS NOT NULL AND income IS NOT NULL
    """,
)
def job_csv_reload(spark: SparkSession, sf: str) -> DataFrame:
    """M11: permissive and strict loads, and the strict one written by flag and read again."""
    out = jobs.csv_load_repartition(spark, stage_finance_csv(spark, sf), FIN_SCHEMA, FIN_NAMES, scratch_path(spark, "job_finances_by_flag"))
    parts = [
        out[load].select(F.lit(load).alias("load"), F.col("id").cast("long").alias("id"), F.col("has_debt").cast("boolean").alias("has_debt"), F.col("income").cast("double").alias("income"))
        for load in ("permissive", "strict", "reread")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register(
    "job_document_store",
    "SELECT c_name AS lastname, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS school, c_custkey AS studentno FROM customer",
)
def job_document_store(spark: SparkSession, sf: str) -> DataFrame:
    """M13: sparse student documents appended to a collection and read back with their schema."""
    key = F.col("c_custkey")
    students = table(spark, sf, "customer").select(F.col("c_name").alias("lastname"), F.when(key % 2 == 0, F.col("c_mktsegment")).alias("school"), key.alias("studentno"))
    return jobs.document_store(students, scratch_path(spark, "job_students"), students.schema)
