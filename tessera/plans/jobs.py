"""The reference's composite jobs (M1-M13) as functions of DataFrames.

Each job takes its inputs as DataFrames (and output locations where it
writes) and returns the DataFrames it produces; no session setup, secrets or
fixed paths live inside.  Column names are parameters where the reference's
datasets and the driver's tables differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import array_profile
from tessera.functions.scalar import exact, parse_bool, parse_date, parse_timestamp, tidy_name
from tessera.operators import aggregates as agg
from tessera.operators import filters, sorting
from tessera.operators.joins import broadcast_if_small, join_on_key
from tessera.operators.nested import explode_field, posexplode_field
from tessera.operators.windows import (
    OrderSpec,
    with_group_aggregate,
    with_income_ranking,
    with_rank_columns,
    with_rolling_mean,
)
from tessera.sinks.files import register_view, write_csv, write_format, write_parquet, write_partitioned
from tessera.sources.files import load_audit, read_csv, read_delimited, read_format, typed_load


def account_report(
    finances: DataFrame, movies_label: str = "Movies", *, tiebreak: str = "TxnId", scale: int | None = None
) -> dict[str, DataFrame]:
    """M1: top amounts, details text, per-account summary and its array report."""
    summary = agg.summarize_by_key(finances, "AccountNumber", "Amount", "Description", set_as_text=False, scale=scale)
    return {
        "top5": sorting.top_k(finances, [F.col("Amount").desc(), F.col(tiebreak).asc()], 5),
        "details": finances.select(F.concat_ws(" - ", "AccountNumber", "Description").alias("AccountDetails")),
        "summary": summary,
        "arrays": summary.select(
            "AccountNumber", "UniqueTransactionDescriptions", *array_profile("UniqueTransactionDescriptions",
                                                                              movies_label)
        ),
    }


def company_tiers(companies: DataFrame, tiers: dict[str, str], default: str = "Standard") -> dict[str, DataFrame]:
    """M2: explode employees, read a struct field, tier companies with CASE."""
    employees = explode_field(companies, ["company"], "employees", "employee")
    positioned = posexplode_field(companies, ["company"], "employees", "employeePosition", "employee")
    names = employees.select("company", F.expr("employee.firstName as firstName"))
    tier = F.lit(default)
    for company, label in reversed(list(tiers.items())):
        tier = F.when(F.col("company") == company, F.lit(label)).otherwise(tier)
    return {"employees": employees, "positioned": positioned, "tiered": names.select("*", tier.alias("Tier"))}


def rolling_accounts(raw_finances: DataFrame, date_format: str = "M/d/yyyy", **window_opts) -> DataFrame:
    """M3: text dates parsed (bad -> NULL), then a 5-row rolling mean per account."""
    dated = raw_finances.withColumn("Date", parse_date("Date", date_format))
    return with_rolling_mean(dated, ["AccountNumber"], OrderSpec("Date", tiebreak=["TxnId"]), "Amount",
                             preceding=4, **window_opts)


def product_ranking(products: DataFrame, tiebreak: str = "product", **window_opts) -> DataFrame:
    """M4: lag, lag with default, row_number, rank, dense_rank per category."""
    return with_rank_columns(products, ["category"], OrderSpec("revenue", tiebreak=[tiebreak]), "revenue",
                             **window_opts)


def order_charge_profile(charges: DataFrame, out_path: str | None = None) -> dict[str, DataFrame]:
    """M5: row count, typed describe, frequency per borough, zip list, daily frequency."""
    daily = with_group_aggregate(charges, ["OMOCreateDate"], F.count("OMOID"), "OMODailyFreq")
    out = {
        "count": agg.row_count(charges),
        "describe": agg.column_stats(charges),
        "frequency": agg.count_by(charges, "Boro", "OrderFrequency"),
        "zips": agg.distinct_values_by(charges, "Boro", F.col("Zip").try_cast("int")),
        "daily": daily,
        "daily_distinct": charges.groupBy("OMOCreateDate").agg(F.count("OMOID").alias("OMODailyFreq")),
    }
    if out_path:
        write_parquet(daily, out_path)
    return out


def transaction_load(text_fields: DataFrame, *, scale: int | None = None) -> dict[str, DataFrame]:
    """M6: positional fields to typed transactions with every line accounted for, then counts and merchant totals."""
    from tessera.plans.transactions import NOT_NULL, TXN_NAMES, TYPED

    good, rejects = typed_load(text_fields, TYPED, TXN_NAMES, NOT_NULL)
    total = F.sum(exact("amount", scale))
    typed = good.withColumn("created_time_ist", parse_timestamp("created_time_ist"))
    return {
        "typed": typed,
        "rejects": rejects,
        "audit": load_audit(good, rejects),
        "count": agg.row_count(typed),
        "merchants": agg.count_distinct(typed, "merchant_id", "n_merchants"),
        "totals": typed.groupBy("merchant_id").agg(
            (total if scale is None else total.cast("double")).alias("total_amount"),
            F.approx_count_distinct("status").alias("dist_status_count"),
        ),
    }


def scholarship_recipients(
    demographics: DataFrame,
    finances: DataFrame,
    courses: DataFrame,
    country: str,
    *,
    flags: tuple[str, ...] = ("has_debt", "has_financial_dependents"),
) -> dict[str, DataFrame]:
    """M7: recipients in a country with the given finance flags, and their course."""
    need = filters.all_of(*[F.col(f) for f in flags])
    recipients = join_on_key(demographics.filter(F.col("country") == country), finances.filter(need), "id")
    with_course = join_on_key(recipients, broadcast_if_small(courses, 100_000), "course_id")
    return {"recipients": recipients, "with_course": with_course}


def people_cleaning(
    people: DataFrame, *, order: list[str], needle: str, listed: list[str], missing_weight: float = 0.0
) -> dict[str, DataFrame]:
    """M8: first, first non-null, max and min per normalised name, tidy names, text predicates on the job.

    ``order`` makes "first" well defined; the words looked for are the caller's.
    """
    key = agg.normalized_key("firstName").alias("name_key")
    name = tidy_name("firstName")
    clean = people.withColumns({
        "firstName": name,
        "fullName": F.format_string("%s %s", name, F.col("lastName")),
        "weightInLbs": F.coalesce("weightInLbs", F.lit(missing_weight)),
    })
    return {
        "first": agg.first_by(people, key, "weightInLbs", order, "first_weight"),
        "first_non_null": agg.first_non_null_by(people, key, "weightInLbs", order, "first_weight"),
        "max_min": agg.max_min_by(people, key, "weightInLbs", max_alias="max_weight", min_alias="min_weight"),
        "clean": clean,
        "matching": filters.where_contains(clean, "jobType", needle),
        "listed": filters.where_in(clean, "jobType", listed),
        "not_listed": filters.where_not_in(clean, "jobType", listed),
    }


def year_layout(orders: DataFrame, date_col: str, out_path: str) -> DataFrame:
    """M9: write partitioned by calendar year, read back for pruned queries."""
    write_partitioned(orders.withColumn("OrderYear", F.year(date_col)), out_path, ["OrderYear"])
    return orders.sparkSession.read.parquet(out_path)


def csv_to_format_ranking(csv_path: str, schema, out_path: str, fmt: str = "orc", spark=None, **window_opts) -> dict[str, DataFrame]:
    """M10: CSV with schema -> another format (ORC here; Avro where its module exists)
    -> pushed-down filter and income ranking per debt flag."""
    fin = read_csv(spark, csv_path, schema)
    write_format(fin, out_path, fmt)
    back = read_format(spark, out_path, fmt)
    return {
        "csv_filtered": fin.select("id", "income", "has_debt").filter("has_debt = true").select("id", "income"),
        "filtered": back.select("id", "income", "has_debt").filter("has_debt = true").select("id", "income"),
        "ranked": with_income_ranking(back, ["has_debt"], OrderSpec("income", True, ["id"]), "income", **window_opts),
    }


def csv_load_repartition(spark, csv_path: str, schema, names: list[str], out_path: str) -> dict[str, DataFrame]:
    """M11: permissive and drop-malformed loads, partitioned CSV write, read back."""
    permissive = read_csv(spark, csv_path, schema)
    strict = read_csv(spark, csv_path, schema, mode="DROPMALFORMED", names=names)
    write_csv(strict, out_path, header=True, sep="~", partition_cols=[names[1]])
    return {"permissive": permissive, "strict": strict, "reread": read_delimited(spark, out_path, sep="~")}


def parse_flags(df: DataFrame, columns: list[str]) -> DataFrame:
    """Boolean words in text columns to booleans (used by text-loaded finances)."""
    return df.withColumns({c: parse_bool(c) for c in columns})


def register_views(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """B7 for a whole job: register each frame as a temp view."""
    return {name: register_view(df, name) for name, df in frames.items()}


def warehouse_load(spark, delimited_path: str, url: str, table: str, *, sep: str = "|", **jdbc) -> DataFrame:
    """M12: landed delimited file -> warehouse table (JDBC), then read back by query.

    ``jdbc`` carries ``user``/``password``/``driver``; the URL is never printed.
    """
    from tessera.sources.jdbc import read_query, write_table

    txn = read_delimited(spark, delimited_path, sep=sep, header=True)
    write_table(txn, url, table, mode="overwrite", truncate=True, **jdbc)
    return read_query(spark, url, f"SELECT * FROM {table}", **jdbc)


def document_store(students: DataFrame, collection_path: str, schema) -> DataFrame:
    """M13: append student documents to a JSON-lines collection, read them back
    with an explicit schema (documents missing a field give NULL)."""
    from tessera.sinks.files import append_json
    from tessera.sources.files import read_json

    append_json(students, collection_path)
    return read_json(students.sparkSession, collection_path, schema)
