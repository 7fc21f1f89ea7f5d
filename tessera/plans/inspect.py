"""Plan and schema inspection: the checks the reference did by eye
(``explain()``, ``printSchema()``), as values tests can assert on."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df))


def partition_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", plan_text(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df))


def count_nodes(df: DataFrame, name: str) -> int:
    """Occurrences of a physical operator (e.g. ``Exchange``) in the final plan."""
    text = plan_text(df, "simple")
    return len(re.findall(rf"\b{re.escape(name)}\b", text))


def schema_matches(df: DataFrame, expected: StructType, *, check_nullable: bool = False) -> bool:
    got = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString(), f.nullable) for f in expected.fields]
    if not check_nullable:
        got = [g[:2] for g in got]
        want = [w[:2] for w in want]
    return got == want
