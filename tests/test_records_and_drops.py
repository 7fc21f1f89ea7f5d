"""VARIANT records, incremental drop folders, chunked sets, and names that users may use."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tessera.functions.udfs import register_text_udfs, title_case_delim
from tessera.operators.aggregates import column_stats, distinct_arrays_by
from tessera.operators.joins import salted_join
from tessera.operators.nested import nest_children, posexplode_field
from tessera.plans.inspect import count_nodes
from tessera.sources.files import load_new_files, read_records, record_audit, record_fields


def _lines(path, lines):
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_records_keep_fields_that_change_type_and_broken_lines_are_counted(spark, tmp_dir):
    path = _lines(f"{tmp_dir}/r.json", ['{"n": 7, "s": "a"}', '{"n": "x-7"}', '{"n": 1.5, "s": null}', '{"n": {"deep": 1}}', '{"n": 7', "", "  ", "plain", "[1, 2]"])
    records = read_records(spark, path)
    audit = record_audit(records).first()
    assert (audit.n_lines, audit.n_records, audit.n_broken) == (7, 5, 2)
    objects = records.where("line like '{%' and record is not null")
    assert record_audit(objects).first().record_schema == "OBJECT<n: VARIANT, s: STRING>"
    got = record_fields(objects, {"n": "variant", "s": "string", "gone": "long"})
    rows = got.select(F.schema_of_variant("n").alias("kind"), F.try_variant_get("n", "$", "long").alias("n"), F.to_json("n").alias("as_json"), "s", "gone").collect()
    assert [(r.kind, r.as_json, r.s, r.gone) for r in rows] == [
        ("BIGINT", "7", "a", None), ("STRING", '"x-7"', None, None), ("DECIMAL(2,1)", "1.5", None, None), ("OBJECT<deep: BIGINT>", '{"deep":1}', None, None),
    ]
    assert rows[0].n == 7 and rows[1].n is None and rows[3].n is None


def test_drop_folder_takes_every_file_once(spark, tmp_dir):
    folder, table, ledger = (os.path.join(tmp_dir, x) for x in ("landed", "taken", "ledger"))
    os.makedirs(folder)
    schema = "id string, name string"
    load = lambda: sorted(map(tuple, load_new_files(spark, folder, table, ledger, schema).collect()))
    _lines(f"{folder}/a.csv", ["id|name", "1|x", "2|y"])
    assert load() == [("1", "x"), ("2", "y")]
    assert load() == [("1", "x"), ("2", "y")]  # nothing new
    _lines(f"{folder}/b.csv", ["id|name", "3|z"])
    _lines(f"{folder}/c.csv", ["id|name", "1|x"])  # a row that repeats in another file is a row
    assert load() == [("1", "x"), ("1", "x"), ("2", "y"), ("3", "z")]
    assert load() == [("1", "x"), ("1", "x"), ("2", "y"), ("3", "z")]


@pytest.mark.parametrize("options", [{"strategy": "window"}, {"strategy": "split", "max_rows_per_key": 20}, {}])
def test_distinct_sets_in_bounded_chunks(spark, options):
    rows = [("hot", str(i % 250)) for i in range(1500)] + [("b", "7"), ("b", None), ("b", "7"), ("c", None), (None, "3"), ("bad", "x")]
    df = spark.createDataFrame(rows, "k string, z string")
    out = distinct_arrays_by(df, "k", F.col("z").try_cast("long"), chunk_size=100, **options).collect()
    assert max(len(r.Zips) for r in out) == 100 and all(r.ZipCount == len(r.Zips) for r in out)
    hot = sorted((r.chunk, r.Zips, r.TotalZips) for r in out if r.k == "hot")
    assert hot == [(0, list(range(100)), 250), (1, list(range(100, 200)), 250), (2, list(range(200, 250)), 250)]
    rest = {r.k: (r.chunk, r.Zips, r.ZipCount, r.TotalZips) for r in out if r.k != "hot"}
    assert rest == {"b": (0, [7], 1, 1), "c": (0, [], 0, 0), None: (0, [3], 1, 1), "bad": (0, [], 0, 0)}


def test_salted_join_keeps_columns_named_like_its_own(spark):
    big = spark.createDataFrame([(i % 3, i, f"s{i}", i) for i in range(60)], "k int, __salt int, __hot string, __n int")
    small = spark.createDataFrame([(0, "a"), (1, "b"), (9, "c")], "k int, __row_salt string")
    for how in ("inner", "left", "left_anti"):
        got, want = salted_join(big, small, ["k"], how, max_rows_per_key=5, salts=4), big.join(small, "k", how)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_nested_records_keep_fields_named_like_their_own(spark):
    df = spark.createDataFrame([("p", 3, "c"), ("p", 1, "a"), ("p", 2, "b")], "__first string, __at int, __position string")
    nested = nest_children(df, "__first", "__at", ["__position"], parent_alias="__children", array_alias="kids", chunk_size=2)
    flat = posexplode_field(nested.withColumn("__first", F.lit("mine")), ["__children", "__first"], "kids", "pos", "kid", first="first_position")
    got = sorted((r["__children"], r["__first"], r.pos, r.kid["__at"], r.kid["__position"]) for r in flat.collect())
    assert got == [("p", "mine", 0, 1, "a"), ("p", "mine", 1, 2, "b"), ("p", "mine", 2, 3, "c")]


@pytest.mark.parametrize("delimiter", ["\\E", "\\Q", "\\E\\E", "a\\E.", ".", "||", "$1"])
def test_delimiters_are_taken_literally(spark, delimiter):
    register_text_udfs(spark)
    df = spark.createDataFrame([(delimiter.join(["one", "tWO", "three"]),)], "t string")
    assert df.select(title_case_delim("t", F.lit(delimiter))).first()[0].lower() == delimiter.join(["One", "Two", "Three"]).lower()


def test_numbers_are_described_by_a_hash_aggregate(spark):
    df = spark.createDataFrame([(1, 2.5, "b"), (3, None, "a"), (None, 7.5, None)], "i int, d double, s string")
    out = column_stats(df)
    assert count_nodes(out, "SortAggregate") == 2 and count_nodes(out, "HashAggregate") == 2  # partial and final, of text and of numbers
    got = {r.column: (r.n, r["mean"], r.min_value, r.max_value, r.min_text, r.max_text) for r in out.collect()}
    assert got == {"i": (2, 2.0, 1.0, 3.0, None, None), "d": (2, 5.0, 2.5, 7.5, None, None), "s": (2, None, None, None, "a", "b")}
