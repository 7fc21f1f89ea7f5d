"""Nested JSON: companies with employee arrays, sparse documents, appends.

Companies come from ``conversations``: company = ``conv_id``, employees =
``array<struct<turn, role>>`` (at most 64 turns per record, with the position
of the first).  They are staged as JSON lines, read back with an explicit schema and flattened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tessera.operators.nested import explode_field, nest_children, posexplode_field
from tessera.plans.registry import register
from tessera.session import scratch_path, staged
from tessera.sinks.files import append_json, write_text_lines
from tessera.sources.files import read_json, read_records, record_audit, record_fields
from tessera.tables import table

CHUNK = 64

COMPANY_SCHEMA = StructType(
    [
        StructField("company", LongType()),
        StructField("first_position", LongType()),
        StructField(
            "employees",
            ArrayType(StructType([StructField("turn", LongType()), StructField("role", StringType())])),
        ),
    ]
)


def stage_companies(spark: SparkSession, sf: str) -> str:
    conv = table(spark, sf, "conversations")
    nested = nest_children(conv, "conv_id", "turn", ["role"], parent_alias="company", array_alias="employees",
                           chunk_size=CHUNK)
    return staged(spark, "companies_json", lambda path: nested.write.mode("overwrite").json(path))


def companies(spark: SparkSession, sf: str) -> DataFrame:
    return read_json(spark, stage_companies(spark, sf), COMPANY_SCHEMA)


@register("json_flatten", "SELECT conv_id AS company, turn, role FROM conversations")
def json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """explode, then struct fields through a column path and a SQL expression."""
    flat = explode_field(companies(spark, sf), ["company"], "employees", "employee")
    return flat.select("company", F.col("employee.turn").alias("turn"), F.expr("employee.role as role"))


@register("json_inferred", "SELECT conv_id AS company, turn, role FROM conversations")
def json_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """The same records read without a schema (inferred in one extra pass)."""
    flat = explode_field(read_json(spark, stage_companies(spark, sf)), ["company"], "employees", "employee")
    return flat.select("company", F.col("employee.turn").alias("turn"), F.col("employee.role").alias("role"))


@register(
    "posexplode_items",
    """
    SELECT conv_id AS company,
           CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) - 1 AS BIGINT) AS employeePosition,
           turn, role
    FROM conversations
    """,
)
def posexplode_items(spark: SparkSession, sf: str) -> DataFrame:
    flat = posexplode_field(companies(spark, sf), ["company"], "employees", "employeePosition", "employee", first="first_position")
    return flat.select(
        "company",
        "employeePosition",
        F.col("employee.turn").alias("turn"),
        F.col("employee.role").alias("role"),
    )


@register(
    "posexplode_events",
    """
    SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS BIGINT) AS event_position,
           event_id, event_type
    FROM events
    """,
)
def posexplode_events(spark: SparkSession, sf: str) -> DataFrame:
    """Users have more events than a record holds (16), so positions run on across records."""
    nested = nest_children(
        table(spark, sf, "events"), "user_id", "event_id", ["event_type"], parent_alias="user_id", array_alias="events", chunk_size=16
    )
    flat = posexplode_field(nested, ["user_id"], "events", "event_position", "event", first="first_position")
    return flat.select("user_id", "event_position", F.col("event.event_id").alias("event_id"), F.col("event.event_type").alias("event_type"))


DOC_SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        StructField("quality", IntegerType()),
        StructField("toxic", IntegerType()),
    ]
)


@register(
    "documents_sparse_json",
    """
    SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def documents_sparse_json(spark: SparkSession, sf: str) -> DataFrame:
    """Documents where only labelled ones carry ``quality``/``toxic``: the
    JSON writer leaves NULL fields out, the schema brings them back as NULL."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf, "labels")
    sparse = docs.join(labels, on="doc_id", how="left")
    path = staged(spark, "documents_json", lambda p: sparse.write.mode("overwrite").json(p))
    return read_json(spark, path, DOC_SCHEMA)


STUDENT_SCHEMA = StructType(
    [
        StructField("c_custkey", LongType()),
        StructField("c_name", StringType()),
        StructField("c_mktsegment", StringType()),
        StructField("c_acctbal", DoubleType()),
    ]
)


@register("json_append", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def json_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends to one JSON-lines collection, read back as one."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    path = scratch_path(spark, "students_json")
    append_json(c.filter(F.col("c_acctbal") >= 0), path)
    append_json(c.filter(~(F.col("c_acctbal") >= 0) | F.col("c_acctbal").isNull()), path)
    return read_json(spark, path, STUDENT_SCHEMA)


# Student records: the number is text for every third one, the school is missing for every
# second, and every eleventh line is cut off.
_RECORDS_SQL = """
    SELECT c_custkey, c_name AS lastname, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS school, c_custkey % 3 = 0 AS as_text
    FROM customer WHERE c_custkey % 11 <> 0
"""


def stage_student_records(spark: SparkSession, sf: str) -> str:
    key = F.col("c_custkey")
    school = F.when(key % 2 == 0, F.col("c_mktsegment")).alias("school")
    record = lambda number: F.to_json(F.struct(F.col("c_name").alias("lastname"), school, number.alias("studentno")))
    whole = F.when(key % 3 == 0, record(F.concat(F.lit("S-"), key))).otherwise(record(key))
    cut = F.when(key % 11 == 0, F.expr("left(line, length(line) - 1)")).otherwise(F.col("line"))
    lines = table(spark, sf, "customer").select("c_custkey", whole.alias("line")).select(cut.alias("value"))
    return staged(spark, "student_records", lambda path: write_text_lines(lines, path))


@register(
    "documents_variant_json",
    f"""
    SELECT lastname, school, CASE WHEN NOT as_text THEN c_custkey END AS studentno,
           CASE WHEN as_text THEN 'S-' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS studentno_text,
           CASE WHEN as_text THEN 'STRING' ELSE 'BIGINT' END AS studentno_type
    FROM ({_RECORDS_SQL}) r
    """,
)
def documents_variant_json(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose ``studentno`` is a number in some and text in others: both are kept, with the type each has."""
    records = read_records(spark, stage_student_records(spark, sf)).where("record is not null")
    fields = record_fields(records, {"lastname": "string", "school": "string", "studentno": "variant"})
    return fields.select(
        "lastname", "school", F.try_variant_get("studentno", "$", "long").alias("studentno"),
        F.try_variant_get("studentno", "$", "string").alias("studentno_text"), F.schema_of_variant("studentno").alias("studentno_type"),
    )


@register(
    "documents_variant_audit",
    """
    SELECT count(*) AS n_lines, count(*) FILTER (WHERE c_custkey % 11 <> 0) AS n_records, count(*) FILTER (WHERE c_custkey % 11 = 0) AS n_broken,
           'OBJECT<lastname: STRING, school: STRING, studentno: VARIANT>' AS record_schema
    FROM customer
    """,
)
def documents_variant_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Lines, records, broken lines, and the schema found by one aggregate: the field of changing type is VARIANT."""
    return record_audit(read_records(spark, stage_student_records(spark, sf)))
