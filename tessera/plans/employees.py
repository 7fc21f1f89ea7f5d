"""Employee/role joins: inner, broadcast, left, right outer, left anti, full,
and the "cross join with a condition" (which is an inner join).

Employees = customers; roles = one row per event user.  The right and full
joins take the employees outside the HOUSEHOLD segment, so that some roles have
no employee.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.joins import cross_with_equality, join_on_key
from tessera.plans.registry import register
from tessera.plans.standins import EXCLUDED_SEGMENT, employees, office_employees, roles

_CTE = f"""
    WITH emp AS (
        SELECT c_custkey AS id, c_name AS firstName, c_mktsegment AS lastName
        FROM customer
    ),
    office AS (SELECT * FROM emp WHERE lastName <> '{EXCLUDED_SEGMENT}'),
    role AS (
        SELECT user_id AS id, arg_min(event_type, (ts, event_id)) AS jobRole
        FROM events GROUP BY user_id
    )
"""


def _sql(select: str) -> str:
    return _CTE + select


_INNER = _sql("SELECT emp.id, firstName, lastName, jobRole FROM emp JOIN role ON emp.id = role.id")


@register("join_inner", _INNER)
def join_inner(spark: SparkSession, sf: str) -> DataFrame:
    return join_on_key(employees(spark, sf), roles(spark, sf), "id", "inner")


@register("join_broadcast", _INNER)
def join_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    """Roles (an aggregate, materialised once) broadcast only when their row
    count is proven under the bound."""
    return join_on_key(employees(spark, sf), roles(spark, sf), "id", "inner", broadcast_right=True,
                       materialize_right=True)


@register("join_left", _sql("SELECT emp.id, firstName, lastName, jobRole FROM emp LEFT JOIN role ON emp.id = role.id"))
def join_left(spark: SparkSession, sf: str) -> DataFrame:
    return join_on_key(employees(spark, sf), roles(spark, sf), "id", "left")


@register(
    "join_right_outer",
    _sql("SELECT role.id, firstName, lastName, jobRole FROM office RIGHT JOIN role ON office.id = role.id"),
)
def join_right_outer(spark: SparkSession, sf: str) -> DataFrame:
    return join_on_key(office_employees(spark, sf), roles(spark, sf), "id", "right_outer")


@register("join_left_anti", _sql("SELECT * FROM emp WHERE NOT EXISTS (SELECT 1 FROM role WHERE role.id = emp.id)"))
def join_left_anti(spark: SparkSession, sf: str) -> DataFrame:
    return join_on_key(employees(spark, sf), roles(spark, sf), "id", "left_anti")


@register(
    "join_full",
    _sql(
        "SELECT coalesce(office.id, role.id) AS id, firstName, lastName, jobRole "
        "FROM office FULL OUTER JOIN role ON office.id = role.id"
    ),
)
def join_full(spark: SparkSession, sf: str) -> DataFrame:
    return join_on_key(office_employees(spark, sf), roles(spark, sf), "id", "full")


@register(
    "join_cross_filtered",
    _sql("SELECT emp.id, firstName, lastName, role.id AS role_id, jobRole FROM emp JOIN role ON emp.id = role.id"),
)
def join_cross_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """Both key columns survive, as in a condition join; the right one is renamed."""
    r = roles(spark, sf).withColumnRenamed("id", "role_id")
    return cross_with_equality(employees(spark, sf), r, "id", "role_id")
