"""User-defined text functions for SQL and the DataFrame DSL.

They are SQL functions: the optimizer puts their body in place of the call, so
they run as built-in expressions, without Python.  A NULL argument gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_CAPITAL = "w -> concat(upper(substring(w, 1, 1)), lower(substring(w, 2)))"

# A quoted pattern that takes the delimiter literally; an end-of-quote mark inside it is quoted apart.
_LITERAL = r"concat('\\Q', replace(delimiter, '\\E', '\\E\\\\E\\Q'), '\\E')"

#: Name -> (parameters, body).  The delimiter is taken literally, not as a pattern.
TEXT_FUNCTIONS = {
    "title_case": ("text STRING", f"array_join(transform(split(text, ' ', -1), {_CAPITAL}), ' ')"),
    "title_case_delim": (
        "text STRING, delimiter STRING",
        f"array_join(transform(split(text, {_LITERAL}, -1), {_CAPITAL}), delimiter)",
    ),
}


def register_function(spark: SparkSession, name: str, parameters: str, body: str, returns: str = "STRING") -> None:
    """Register a SQL function for the session; a name registered again is replaced (the last one wins)."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {returns} RETURN {body}")


def register_text_udfs(spark: SparkSession) -> None:
    """Register the text functions under names of our own, never over a built-in such as ``initcap``."""
    for name, (parameters, body) in TEXT_FUNCTIONS.items():
        register_function(spark, name, parameters, body)


def title_case(text) -> Column:
    """Capitalise every space-separated word, lower-case the rest (after :func:`register_text_udfs`)."""
    return F.call_function("title_case", F.col(text) if isinstance(text, str) else text)


def title_case_delim(text, delimiter) -> Column:
    """Two-argument form: the delimiter comes in as a column (usually ``lit``)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in (text, delimiter)]
    return F.call_function("title_case_delim", *cols)
