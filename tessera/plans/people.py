"""People cleaning, first/max/min per group, predicates and text parsing.

People = events: the name is the event type written in one of three dirty
forms (upper case, leading space, trailing space), the weight is the event
value with NULL for error events.  Text predicates use ``part`` and
``customer``; parsing uses text made from ``orders``, ``customer`` and
``events`` columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalar import FALSE_WORDS, TRUE_WORDS, parse_bool, parse_date, safe_cast, tidy_name
from tessera.operators import aggregates as agg
from tessera.operators import filters, sorting
from tessera.plans.registry import register
from tessera.tables import table

# The event type whose value is treated as missing, and the
# word list cycled through events for boolean parsing.
MISSING_WEIGHT_EVENT = "error"
BOOL_WORDS = ["y", "Yes", "t", "TRUE", "on", "1", "n", "No", "f", "false", "OFF", "0", "maybe"]

_PEOPLE_SQL = f"""
    SELECT event_id, user_id, ts,
           CASE event_id % 3 WHEN 0 THEN upper(event_type)
                             WHEN 1 THEN ' ' || event_type
                             ELSE event_type || ' ' END AS firstName,
           CASE WHEN event_type = '{MISSING_WEIGHT_EVENT}' THEN NULL ELSE value END AS weightInLbs
    FROM events
"""


def people(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    form = F.col("event_id") % 3
    name = (
        F.when(form == 0, F.upper("event_type"))
        .when(form == 1, F.concat(F.lit(" "), F.col("event_type")))
        .otherwise(F.concat(F.col("event_type"), F.lit(" ")))
    )
    weight = F.when(F.col("event_type") == MISSING_WEIGHT_EVENT, F.lit(None)).otherwise(F.col("value"))
    return e.select("event_id", "user_id", "ts", name.alias("firstName"), weight.alias("weightInLbs"))


# --- E8-E11, I5 -----------------------------------------------------------


@register(
    "first_by_key",
    f"SELECT user_id, arg_min_null(weightInLbs, (ts, event_id)) AS first_weight FROM ({_PEOPLE_SQL}) p GROUP BY user_id",
)
def first_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """``first`` made deterministic: the weight of the earliest event (may be NULL)."""
    return agg.first_by(people(spark, sf), "user_id", "weightInLbs", ["ts", "event_id"], "first_weight")


@register(
    "first_non_null",
    f"""
    SELECT user_id, arg_min(weightInLbs, (ts, event_id)) FILTER (WHERE weightInLbs IS NOT NULL) AS first_weight
    FROM ({_PEOPLE_SQL}) p GROUP BY user_id
    """,
)
def first_non_null(spark: SparkSession, sf: str) -> DataFrame:
    return agg.first_non_null_by(people(spark, sf), "user_id", "weightInLbs", ["ts", "event_id"], "first_weight")


@register(
    "max_min_by_key",
    f"""
    SELECT trim(lower(firstName)) AS name_key, max(weightInLbs) AS max_weight, min(weightInLbs) AS min_weight
    FROM ({_PEOPLE_SQL}) p GROUP BY 1
    """,
)
def max_min_by_key(spark: SparkSession, sf: str) -> DataFrame:
    p = people(spark, sf)
    return agg.max_min_by(p, agg.normalized_key("firstName").alias("name_key"), "weightInLbs",
                          max_alias="max_weight", min_alias="min_weight")


@register(
    "group_by_expr",
    f"""
    SELECT trim(lower(firstName)) AS name_key, count(*) AS n_people,
           count(DISTINCT firstName) AS n_spellings
    FROM ({_PEOPLE_SQL}) p GROUP BY 1
    """,
)
def group_by_expr(spark: SparkSession, sf: str) -> DataFrame:
    """Group on ``trim(lower(name))``: the dirty spellings fall together."""
    p = people(spark, sf)
    return p.groupBy(agg.normalized_key("firstName").alias("name_key")).agg(
        F.count(F.lit(1)).alias("n_people"), F.count_distinct("firstName").alias("n_spellings")
    )


# --- I2-I4, I6, C8, M8 ----------------------------------------------------

# Fixed value: parts above this size get a missing weight.
MISSING_WEIGHT_SIZE = 40


@register(
    "people_clean",
    f"""
    WITH p AS (
        SELECT p_partkey, p_brand,
               trim(array_to_string(list_transform(
                   string_split(lower(CASE p_partkey % 2 WHEN 0 THEN ' ' || p_name ELSE p_name || ' ' END), ' '),
                   lambda w: upper(substring(w, 1, 1)) || substring(w, 2)), ' ')) AS firstName,
               CASE WHEN p_size > {MISSING_WEIGHT_SIZE} THEN NULL ELSE p_retailprice END AS weight
        FROM part
    )
    SELECT p_partkey, firstName, printf('%s %s', firstName, p_brand) AS fullName,
           coalesce(weight, 0.0) AS weightInLbs
    FROM p
    """,
)
def people_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Tidy names, a formatted full name, a default weight: one projection."""
    p = table(spark, sf, "part")
    raw = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" "), F.col("p_name"))).otherwise(
        F.concat(F.col("p_name"), F.lit(" "))
    )
    weight = F.when(F.col("p_size") > MISSING_WEIGHT_SIZE, F.lit(None)).otherwise(F.col("p_retailprice"))
    name = tidy_name(raw)
    full = F.format_string("%s %s", name, F.col("p_brand"))
    return p.select("p_partkey", name.alias("firstName"), full.alias("fullName"), F.coalesce(weight, F.lit(0.0)).alias("weightInLbs"))


# --- C11-C13 --------------------------------------------------------------


@register("filter_contains", "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring')")
def filter_contains(spark: SparkSession, sf: str) -> DataFrame:
    return filters.where_contains(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", "ring")


@register(
    "filter_isin",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE lower(c_mktsegment) IN ('building', 'machinery', 'shipyard')",
)
def filter_isin(spark: SparkSession, sf: str) -> DataFrame:
    """Listed values in any case, one of which no row has."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return filters.where_in(c, "c_mktsegment", ["BUILDING", "Machinery", "shipyard"])


@register(
    "filter_not_in",
    """
    SELECT c_custkey, nullif(c_mktsegment, 'HOUSEHOLD') AS jobType FROM customer
    WHERE lower(nullif(c_mktsegment, 'HOUSEHOLD')) NOT IN ('building', 'machinery')
    """,
)
def filter_not_in(spark: SparkSession, sf: str) -> DataFrame:
    """``NOT IN`` drops the NULL job types too."""
    c = table(spark, sf, "customer")
    jobs = c.select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("jobType"))
    return filters.where_not_in(jobs, "jobType", ["building", "machinery"])


# --- C5, C18, I14, I15 ----------------------------------------------------


def _sql_list(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


@register(
    "parse_bool",
    f"""
    WITH w AS (SELECT event_id, list_extract([{_sql_list(BOOL_WORDS)}], event_id % {len(BOOL_WORDS)} + 1) AS word
               FROM events)
    SELECT event_id, word,
           CASE WHEN lower(word) IN ({_sql_list(TRUE_WORDS)}) THEN true
                WHEN lower(word) IN ({_sql_list(FALSE_WORDS)}) THEN false END AS flag
    FROM w
    """,
)
def parse_bool_words(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    words = F.array(*[F.lit(w) for w in BOOL_WORDS])
    word = F.element_at(words, (F.col("event_id") % len(BOOL_WORDS) + 1).cast("int"))
    return e.select("event_id", word.alias("word")).withColumn("flag", parse_bool("word"))


@register(
    "try_cast_zip",
    """
    SELECT c_custkey, substring(c_name, 10) AS zip_text,
           TRY_CAST(substring(c_name, 10) AS INTEGER) AS Zip,
           TRY_CAST(c_name AS INTEGER) AS bad_zip
    FROM customer
    """,
)
def try_cast_zip(spark: SparkSession, sf: str) -> DataFrame:
    """A bad value casts to NULL instead of failing the job (ANSI mode is on)."""
    c = table(spark, sf, "customer")
    text = F.substring("c_name", 10, 1 << 30)
    return c.select(
        "c_custkey", text.alias("zip_text"), safe_cast(text, "int").alias("Zip"), safe_cast("c_name", "int").alias("bad_zip")
    )


_DATE_TEXT_SQL = """
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%-m/%-d/%Y')
                              WHEN 'O' THEN strftime(o_orderdate, '%m/%d/%Y')
                              ELSE 'n/a' END AS date_text,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS "Date"
    FROM orders
"""


def _date_text(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "M/d/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "MM/dd/yyyy"))
        .otherwise(F.lit("n/a"))
    )
    return o.select("o_orderkey", text.alias("date_text"))


@register("parse_date", _DATE_TEXT_SQL)
def parse_date_dsl(spark: SparkSession, sf: str) -> DataFrame:
    """Padded and unpadded month/day text to dates; bad text gives NULL."""
    return _date_text(spark, sf).withColumn("Date", parse_date("date_text", "M/d/yyyy"))


@register("parse_date_sql", _DATE_TEXT_SQL)
def parse_date_sql(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        "SELECT o_orderkey, date_text, CAST(try_to_timestamp(date_text, 'M/d/yyyy') AS DATE) AS Date FROM {raw}",
        raw=_date_text(spark, sf),
    )


# --- G3 -------------------------------------------------------------------


@register("sort_nulls_last", f"SELECT * FROM ({_PEOPLE_SQL}) p ORDER BY weightInLbs ASC NULLS LAST, event_id")
def sort_nulls_last(spark: SparkSession, sf: str) -> DataFrame:
    """All people by weight ascending, missing weights last."""
    return sorting.sort_nulls_last(people(spark, sf), "weightInLbs", tiebreak=["event_id"])
