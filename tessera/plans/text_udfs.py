"""Title-casing part names: registered SQL function (DSL and SQL) and the column form.

Python's ``str.capitalize`` upper-cases the first character and lower-cases
the rest of each space-separated piece; the oracle spells that out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalar import capitalize_words
from tessera.functions.udfs import register_text_udfs, title_case, title_case_delim
from tessera.plans.registry import register
from tessera.tables import table

_TITLE_SQL = """
    SELECT p_partkey,
           array_to_string(list_transform(string_split(p_name, ' '),
               lambda w: upper(substring(w, 1, 1)) || lower(substring(w, 2))), ' ') AS title
    FROM part
"""


@register("title_case", _TITLE_SQL)
def title_case_dsl(spark: SparkSession, sf: str) -> DataFrame:
    register_text_udfs(spark)
    return table(spark, sf, "part").select("p_partkey", title_case("p_name").alias("title"))


@register("title_case_sql", _TITLE_SQL)
def title_case_sql(spark: SparkSession, sf: str) -> DataFrame:
    register_text_udfs(spark)
    return spark.sql("SELECT p_partkey, title_case(p_name) AS title FROM {parts}", parts=table(spark, sf, "part"))


@register(
    "title_case_delim",
    """
    SELECT p_partkey,
           array_to_string(list_transform(string_split(p_name, ' '),
               lambda w: upper(substring(w, 1, 1)) || lower(substring(w, 2))), ' ') AS title,
           array_to_string(list_transform(string_split(p_name, ' '),
               lambda w: upper(substring(w, 1, 1)) || lower(substring(w, 2))), ' ') AS title_udf
    FROM part
    """,
)
def title_case_with_delimiter(spark: SparkSession, sf: str) -> DataFrame:
    """Delimiter passed as a literal column: the column form and the two-argument SQL function."""
    register_text_udfs(spark)
    p = table(spark, sf, "part")
    return p.select(
        "p_partkey",
        capitalize_words("p_name", " ").alias("title"),
        title_case_delim("p_name", F.lit(" ")).alias("title_udf"),
    )
