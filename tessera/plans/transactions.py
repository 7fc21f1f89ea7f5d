"""Transaction load and per-merchant totals (``lineitem`` as ``txn_fct``).

The load stages the transactions as pipe-delimited text with a header line
(``txn_id|…``) in the shared folder, then reads it the way the reference
does: text lines, header dropped, split, positional typing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalar import parse_timestamp
from tessera.operators import aggregates as agg
from tessera.operators import sketches as sk
from tessera.plans.registry import register
from tessera.plans.standins import transactions
from tessera.session import materialize, staged
from tessera.sinks.files import write_csv, write_text_lines
from tessera.sources.files import fields_to_columns, load_audit, read_text_fields, typed_load
from tessera.tables import table

# The transaction file's field names and types.
TXN_NAMES = ["txn_id", "created_time_str", "amount", "cust_id", "status", "merchant_id", "created_time_ist"]
# Types the untyped load gives (first field parsed as a number, the rest text).
LOOSE_TYPES = ["long", "string", "double", "string", "string", "string", "string"]
# The explicit schema: txn_id and created_time_str are declared non-null.
TYPED = ["long", "long", "double", "long", "int", "long", "string"]
NOT_NULL = ["txn_id", "created_time_str"]


def stage_transaction_text(spark: SparkSession, sf: str) -> str:
    """Write the transactions as ``|``-separated text with header lines."""
    return staged(spark, "txn_fct", lambda path: write_csv(transactions(spark, sf), path, header=True, sep="|"))


def load_transactions(spark: SparkSession, path: str) -> DataFrame:
    fields = read_text_fields(spark, path, delimiter="|", header_prefix="txn_id")
    return fields


@register(
    "text_to_columns",
    """
    SELECT l_orderkey AS txn_id,
           CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR) AS created_time_string,
           l_extendedprice AS amount,
           CAST(l_partkey AS VARCHAR) AS cust_id,
           CAST(l_linenumber AS VARCHAR) AS status,
           CAST(l_suppkey AS VARCHAR) AS merchant_id,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS created_time_ist
    FROM lineitem
    """,
)
def text_to_columns(spark: SparkSession, sf: str) -> DataFrame:
    fields = load_transactions(spark, stage_transaction_text(spark, sf))
    names = ["txn_id", "created_time_string", "amount", "cust_id", "status", "merchant_id", "created_time_ist"]
    return fields_to_columns(fields, LOOSE_TYPES, names)


@register(
    "txn_typed",
    """
    SELECT l_orderkey AS txn_id,
           CAST(epoch(l_shipdate) AS BIGINT) AS created_time_str,
           l_extendedprice AS amount,
           l_partkey AS cust_id,
           l_linenumber AS status,
           l_suppkey AS merchant_id,
           l_shipdate AS created_time_ist
    FROM lineitem
    """,
)
def txn_typed(spark: SparkSession, sf: str) -> DataFrame:
    fields = load_transactions(spark, stage_transaction_text(spark, sf))
    typed, _ = typed_load(fields, TYPED, TXN_NAMES, NOT_NULL)
    return typed.withColumn("created_time_ist", parse_timestamp("created_time_ist").cast("timestamp_ntz"))


@register(
    "text_unnamed",
    """
    SELECT l_orderkey AS _1, CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR) AS _2, l_extendedprice AS _3,
           CAST(l_partkey AS VARCHAR) AS _4, CAST(l_linenumber AS VARCHAR) AS _5, CAST(l_suppkey AS VARCHAR) AS _6,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS _7
    FROM lineitem
    """,
)
def text_unnamed(spark: SparkSession, sf: str) -> DataFrame:
    """Positional columns without names (``_1`` to ``_7``)."""
    return fields_to_columns(load_transactions(spark, stage_transaction_text(spark, sf)), LOOSE_TYPES)


@register(
    "txn_load_audit",
    """
    SELECT count(*) AS total,
           count(*) FILTER (WHERE l_linenumber NOT IN (4, 5, 6, 7)) AS good,
           count(*) FILTER (WHERE l_linenumber = 7) AS short_line,
           count(*) FILTER (WHERE l_linenumber = 6) AS long_line,
           count(*) FILTER (WHERE l_linenumber = 5) AS null_key,
           count(*) FILTER (WHERE l_linenumber = 4) AS bad_value
    FROM lineitem
    """,
)
def txn_load_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The typed load accounts for every line of a file with injected bad lines:
    short (line 7), too long (6), no key (5), a number that is none (4)."""
    t, n = transactions(spark, sf), F.col("status")
    fields = [F.col(c).cast("string") for c in TXN_NAMES]
    no_key = [F.lit(""), *fields[1:]]
    bad = [*fields[:2], F.lit("n/a"), *fields[3:]]
    join = lambda cols: F.concat_ws("|", *cols)
    line = (
        F.when(n == 7, join(fields[:4])).when(n == 6, join([*fields, F.lit("more")])).when(n == 5, join(no_key)).when(n == 4, join(bad)).otherwise(join(fields))
    )
    path = staged(spark, "txn_bad_lines", lambda p: write_text_lines(t.select(line.alias("value")), p))
    good, rejects = typed_load(read_text_fields(spark, path, delimiter="|"), TYPED, TXN_NAMES, NOT_NULL)
    return load_audit(good, rejects)


@register(
    "merchant_totals",
    """
    SELECT l_suppkey AS merchant_id,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
           count(DISTINCT l_linenumber) AS dist_status_count
    FROM lineitem GROUP BY l_suppkey
    """,
)
def merchant_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Sum per merchant and approximate distinct statuses.

    No ``repartition(n, merchant_id)`` first: it would make the aggregate
    skip its map-side partial step and shuffle every raw row.
    """
    t = transactions(spark, sf)
    return t.groupBy("merchant_id").agg(
        F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total_amount"),
        F.approx_count_distinct("status").alias("dist_status_count"),
    )


@register("approx_distinct", "SELECT count(DISTINCT l_linenumber) AS dist_status_count FROM lineitem")
def approx_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return agg.approx_distinct(transactions(spark, sf), "status", "dist_status_count")


@register("count_distinct_merchants", "SELECT count(DISTINCT l_suppkey) AS n_merchants FROM lineitem")
def count_distinct_merchants(spark: SparkSession, sf: str) -> DataFrame:
    return agg.count_distinct(transactions(spark, sf), "merchant_id", "n_merchants")


@register(
    "approx_distinct_merged",
    """
    SELECT 'orders of a merchant' AS scope, CAST(l_suppkey AS VARCHAR) AS grp, count(DISTINCT l_orderkey) AS n_exact, true AS within_error, true AS merged_as_direct
    FROM lineitem GROUP BY l_suppkey
    UNION ALL SELECT 'orders', 'all', count(DISTINCT l_orderkey), true, true FROM lineitem
    UNION ALL SELECT 'customers of a priority', o_orderpriority, count(DISTINCT o_custkey), true, true FROM orders GROUP BY o_orderpriority
    UNION ALL SELECT 'customers', 'all', count(DISTINCT o_custkey), true, true FROM orders
    """,
)
def approx_distinct_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Stored sketches merged upwards: merchant and month -> merchant -> all, priority and day -> priority -> all.

    Each estimate is held against the exact count (four standard deviations)
    and against the sketch of the group's own rows.
    """
    lines = table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("grp"), F.trunc("l_shipdate", "month").alias("period"), F.col("l_orderkey").alias("v"))
    orders = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("grp"), F.to_date("o_orderdate").alias("period"), F.col("o_custkey").alias("v"))
    out = None
    for rows, fine, coarse in ((lines, "orders of a merchant", "orders"), (orders, "customers of a priority", "customers")):
        stored = materialize(sk.sketch_by(rows, ["grp", "period"], "v"), "distinct_sketches")
        by_group = materialize(sk.merge_sketches(stored, ["grp"]), "merged_sketches")
        everything = rows.withColumn("grp", F.lit("all"))
        for scope, merged, own in ((fine, by_group, rows), (coarse, sk.merge_sketches(by_group, []).withColumn("grp", F.lit("all")), everything)):
            direct = sk.sketch_by(own, ["grp"], "v").select("grp", sk.estimated().alias("direct"))
            exact = own.groupBy("grp").agg(F.count_distinct("v").alias("n_exact"))
            got = merged.select("grp", sk.estimated().alias("estimate")).join(direct, "grp").join(exact, "grp")
            near = F.abs(F.col("estimate") - F.col("n_exact")) <= F.ceil(F.col("n_exact") * sk.relative_error(deviations=4))
            got = got.select(F.lit(scope).alias("scope"), "grp", "n_exact", near.alias("within_error"), (F.col("estimate") == F.col("direct")).alias("merged_as_direct"))
            out = got if out is None else out.unionByName(got)
    return out
