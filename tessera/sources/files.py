"""File sources: Parquet, SQL-on-file, CSV (three modes), delimited text,
JSON lines, any other format by name, and positional text lines.

Every reader is lazy and declarative: projections and filters applied later
reach the scan (``ReadSchema`` / ``PushedFilters`` in the plan).  Schemas are
given explicitly wherever the caller knows them; inference costs an extra pass
over the data and is only used when asked for.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.functions.scalar import not_header, split_fields


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan; ``columns`` prunes the read schema."""
    df = spark.read.format("parquet").load(path)
    return df.select(*columns) if columns else df


def sql_on_file(spark: SparkSession, path: str, fmt: str = "parquet", select: str = "*") -> DataFrame:
    """Query a file directly from SQL: ``SELECT … FROM parquet.`path```."""
    if "`" in path:
        raise ValueError("path may not contain a backtick")
    return spark.sql(f"SELECT {select} FROM {fmt}.`{path}`")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    *,
    mode: str = "PERMISSIVE",
    header: bool = False,
    sep: str = ",",
    infer_schema: bool = False,
    names: list[str] | None = None,
) -> DataFrame:
    """CSV read.

    ``PERMISSIVE`` keeps every line and sets cells that do not parse (or are
    missing) to NULL.  ``DROPMALFORMED`` drops lines with any bad or missing
    cell, whatever the caller later selects: CSV column pruning would
    otherwise parse only the selected cells, so ``count()`` or a narrow
    projection would keep bad lines.  ``names`` renames all columns by
    position (``toDF``).
    """
    base = spark.read.format("csv").option("header", header).option("sep", sep)
    mode = mode.upper()
    if schema is None and infer_schema:
        # One extra pass to infer types; then read with the inferred schema.
        schema = base.option("inferSchema", True).load(path).schema
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    reader = base.option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if mode == "DROPMALFORMED":
        # A hash of all columns is never out of range, but asking for it makes the reader parse every
        # cell of every line, whatever the caller selects later (tests hold this).
        df = df.filter(F.hash(*[F.col(f"`{c}`") for c in df.columns]).between(-(1 << 31), (1 << 31) - 1))
    if names:
        df = df.toDF(*names)
    return df


def read_delimited(spark: SparkSession, path: str, sep: str = "|", header: bool = True) -> DataFrame:
    """Delimited text, every column a string (landed drop-folder files)."""
    return spark.read.format("csv").option("sep", sep).option("header", header).load(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines; with a schema, fields missing from a record come back NULL."""
    reader = spark.read.format("json")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_records(spark: SparkSession, path: str, *, column: str = "record", raw: str = "line") -> DataFrame:
    """JSON lines as VARIANT records, beside the line itself; a broken line's record is NULL (blank lines are left out).

    No schema is needed, and a field keeps the type that each record gives it.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.try_parse_json("value").alias(column), F.col("value").alias(raw))


def record_fields(records: DataFrame, fields: dict[str, str], column: str = "record") -> DataFrame:
    """Typed columns from VARIANT records: name -> type; what a record lacks or can't be cast is NULL.

    The type ``variant`` keeps the field as it is, whatever its type.
    """
    return records.select(*[F.try_variant_get(column, f"$['{name}']", kind).alias(name) for name, kind in fields.items()])


def record_audit(records: DataFrame, column: str = "record") -> DataFrame:
    """One row: lines, records, broken lines, and the schema all records share (``record_schema``, text).

    One distributed aggregate.  A field whose type differs between records is
    VARIANT in the schema.
    """
    known = F.col(column).isNotNull()
    counts = [F.count(F.lit(1)).alias("n_lines"), F.count_if(known).alias("n_records"), F.count_if(~known).alias("n_broken")]
    return records.agg(*counts, F.schema_of_variant_agg(column).alias("record_schema"))


def load_new_files(
    spark: SparkSession, folder: str, table_path: str, ledger: str, schema: StructType | str, *, sep: str = "|", header: bool = True
) -> DataFrame:
    """Take what has landed in a drop folder since the last call, and return all that was taken.

    A file stream that runs until no new file is left: its checkpoint folder
    (``ledger``) is the record of files already taken, and its sink commits a
    batch as a whole.  So every file is loaded once, also if a call dies half
    way and is made again.  All three folders must be shared by the cluster.
    """
    landed = spark.readStream.format("csv").schema(schema).option("sep", sep).option("header", header).load(folder)
    stream = landed.writeStream.format("parquet").option("checkpointLocation", ledger).option("path", table_path).trigger(availableNow=True).start()
    stream.awaitTermination()
    return spark.read.parquet(table_path)


def read_format(spark: SparkSession, path: str, fmt: str, schema: StructType | str | None = None) -> DataFrame:
    """Any registered format by name (``orc``, ``avro`` when its module is present)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_text_fields(
    spark: SparkSession,
    path: str,
    *,
    delimiter: str = "|",
    header_prefix: str | None = None,
) -> DataFrame:
    """Text lines split into an array column ``fields`` (header line dropped).

    A line is dropped as a header when it starts with ``header_prefix``.
    """
    lines = spark.read.text(path)
    if header_prefix:
        lines = lines.filter(not_header("value", header_prefix))
    return lines.select(split_fields("value", delimiter).alias("fields"))


def fields_to_columns(
    fields_df: DataFrame,
    types: list[str],
    names: list[str] | None = None,
) -> DataFrame:
    """Positional fields to typed columns (``toDF()`` gives ``_1.._n``; ``names`` renames).

    A field that a short line lacks, or whose text does not fit the type, is
    NULL instead of failing the job; :func:`typed_load` tells which.
    """
    names = names or [f"_{i + 1}" for i in range(len(types))]
    return fields_df.select(*[_typed(i, t).alias(n) for i, (t, n) in enumerate(zip(types, names, strict=True))])


def _typed(i: int, to_type: str) -> Column:
    field = F.get("fields", F.lit(i))
    return field if to_type == "string" else field.try_cast(to_type)


def typed_load(fields_df: DataFrame, types: list[str], names: list[str], not_null: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``: every line is in one of them.

    ``rejects`` has the raw ``fields`` and a ``reason``, the first that holds:
    ``short_line``, ``long_line`` (number of fields), ``null_key`` (a declared
    non-null field is missing or empty), ``bad_value`` (a non-empty field that
    does not fit its type).
    """
    empty = lambda i: F.coalesce(F.trim(F.get("fields", F.lit(i))), F.lit("")) == ""
    missing = [empty(names.index(c)) for c in not_null]
    unfit = [~empty(i) & _typed(i, t).isNull() for i, t in enumerate(types) if t != "string"]
    no = F.lit(False)
    reason = (
        F.when(F.size("fields") < len(types), "short_line")
        .when(F.size("fields") > len(types), "long_line")
        .when(reduce(or_, missing, no), "null_key")
        .when(reduce(or_, unfit, no), "bad_value")
    )
    judged = fields_df.select("fields", reason.alias("reason"))
    good = fields_to_columns(judged.where("reason is null").select("fields"), types, names)
    return good, judged.where("reason is not null")


#: Reasons of :func:`typed_load`, in the order they are tested.
REJECT_REASONS = ("short_line", "long_line", "null_key", "bad_value")


def load_audit(good: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row: ``total, good`` and the number of lines rejected for each reason."""
    by_reason = [F.count_if(F.col("reason") == r).alias(r) for r in REJECT_REASONS]
    counts = good.select(F.lit(None).cast("string").alias("reason")).unionByName(rejects.select("reason"))
    return counts.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("reason").isNull()).alias("good"), *by_reason)


def enforce_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep rows whose declared non-null columns are present (a plain filter;
    :func:`typed_load` keeps and counts what it rejects)."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)
