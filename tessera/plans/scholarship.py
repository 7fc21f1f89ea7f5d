"""Scholarship recipients: three ways to write one answer, plus the course
lookup and the practice variant.

Demographics = customers with their nation as country; finance flags =
orders keyed by customer; courses = nations.  "Switzerland" is ``NATION_5``.
A participant appears once per matching finance record (pair-join semantics).
All three forms compile to one plan: filters are pushed below the join and
the equality becomes an equi-join key (never a Cartesian product).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.joins import broadcast_if_small, join_on_condition, join_on_key, salted_join
from tessera.plans.registry import register
from tessera.plans.standins import (
    DEBT_STATUS,
    DEPENDENTS_PRIORITY,
    DIMENSION_ROWS,
    LOANS_INCOME_OVER,
    SWITZERLAND,
    courses,
    demographics,
    finance_flags,
)
from tessera.sinks.layout import join_stored, write_bucketed

_BASE = f"""
    SELECT c.c_custkey AS id, n.n_name AS country, c.c_acctbal < 0 AS negative_balance,
           c.c_nationkey AS course_id, o.o_orderkey AS finance_id,
           o.o_orderstatus = '{DEBT_STATUS}' AS has_debt,
           o.o_orderpriority = '{DEPENDENTS_PRIORITY}' AS has_financial_dependents,
           o.o_totalprice > {LOANS_INCOME_OVER} AS has_student_loans,
           o.o_totalprice AS income
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN orders o ON o.o_custkey = c.c_custkey
"""
_RECIPIENTS_SQL = f"""
    SELECT * FROM ({_BASE}) b
    WHERE country = '{SWITZERLAND}' AND has_debt AND has_financial_dependents
"""


def in_country(country: str = SWITZERLAND) -> Column:
    return F.col("country") == country


def in_need() -> Column:
    return F.col("has_debt") & F.col("has_financial_dependents")


@register("scholarship_filter_join", _RECIPIENTS_SQL)
def scholarship_filter_join(spark: SparkSession, sf: str) -> DataFrame:
    """Filter each side first, then join on the participant id."""
    demo = demographics(spark, sf).filter(in_country())
    fin = finance_flags(spark, sf).filter(in_need())
    return join_on_key(demo, fin, "id", "inner")


@register("scholarship_join_filter", _RECIPIENTS_SQL)
def scholarship_join_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Join first, then filter; the optimizer pushes the filter below the join."""
    joined = join_on_key(demographics(spark, sf), finance_flags(spark, sf), "id", "inner")
    return joined.filter(in_country() & in_need())


@register("scholarship_cartesian", _RECIPIENTS_SQL)
def scholarship_cartesian(spark: SparkSession, sf: str) -> DataFrame:
    """The "all pairs, keep equal ids, then the predicate" form, written as the
    equi-join it amounts to."""
    demo = demographics(spark, sf)
    fin = finance_flags(spark, sf).withColumnRenamed("id", "fin_id")
    pairs = join_on_condition(demo, fin, demo["id"] == fin["fin_id"], "inner")
    return pairs.filter(in_country() & in_need()).drop("fin_id")


@register(
    "scholarship_course",
    f"""
    SELECT r.*, cn.n_name AS course_name
    FROM ({_RECIPIENTS_SQL}) r JOIN nation cn ON r.course_id = cn.n_nationkey
    """,
)
def scholarship_course(spark: SparkSession, sf: str) -> DataFrame:
    """Recipients re-keyed on their course id, joined to courses (a small
    dimension: broadcast under a checked bound), keyed back by participant."""
    recipients = scholarship_filter_join(spark, sf)
    course = broadcast_if_small(courses(spark, sf), DIMENSION_ROWS)
    return join_on_key(recipients, course, "course_id", "inner")


@register(
    "scholarship_variant",
    f"""
    SELECT * FROM ({_BASE}) b
    WHERE country = '{SWITZERLAND}' AND negative_balance AND has_student_loans
    """,
)
def scholarship_variant(spark: SparkSession, sf: str) -> DataFrame:
    """Practice variant: country, a demographic flag and the student-loan flag."""
    joined = join_on_key(demographics(spark, sf), finance_flags(spark, sf), "id", "inner")
    return joined.filter(in_country() & F.col("negative_balance") & F.col("has_student_loans"))


@register("scholarship_join_salted", _RECIPIENTS_SQL)
def scholarship_join_salted(spark: SparkSession, sf: str) -> DataFrame:
    """Filter both sides, then join with explicit salting of busy
    participants: every participant with more than 5 matching finance records
    is spread over 8 tasks (the demographics row is repeated per salt).
    Filters go first because the salt (a hash of the whole row) stops the
    optimizer from pushing predicates below it."""
    fin = finance_flags(spark, sf).filter(in_need())
    demo = demographics(spark, sf).filter(in_country())
    return salted_join(fin, demo, ["id"], "inner", max_rows_per_key=5, salts=8)


def stored_recipients(demo: DataFrame, fin: DataFrame, course: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Recipients from tables bucketed by participant, then with their course from tables bucketed by course.

    Participants and finance records meet bucket by bucket, without an
    exchange; re-keying by course is the one shuffle, paid in the write.
    """
    people, records = write_bucketed(demo, ["id"], name="participants"), write_bucketed(fin, ["id"], name="finance_flags")
    recipients = join_stored(records.filter(in_need()), people.filter(in_country()), ["id"])
    by_course = write_bucketed(recipients, ["course_id"], name="recipients")
    return recipients, join_stored(by_course, write_bucketed(course, ["course_id"], name="courses"), ["course_id"])


@register(
    "scholarship_bucketed",
    f"""
    SELECT r.*, cn.n_name AS course_name
    FROM ({_RECIPIENTS_SQL}) r JOIN nation cn ON r.course_id = cn.n_nationkey
    """,
)
def scholarship_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Co-partitioned stored tables: no exchange on either side of either join."""
    return stored_recipients(demographics(spark, sf), finance_flags(spark, sf), courses(spark, sf))[1]
