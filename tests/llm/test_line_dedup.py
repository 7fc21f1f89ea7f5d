import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.llm import queries
from tessera.llm.line_dedup import LineRuns, dedup_lines
from tessera.llm.line_dedup import line_keys
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOCS, ascii_lower, odd_rows, with_clashes


def brute(rows, min_chars=10):
    key = lambda line: ascii_lower(line.strip(" \t\n\x0b\x0c\r"))
    owner = {}
    for doc, text, *_ in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= min_chars:
                    owner[key(line)] = min(doc, owner.get(key(line), doc))
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or owner.get(key(x), doc) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect()), key=str)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2), (4, 3)])
def test_matches_brute_force_for_any_batches(spark, batches, fanout):
    rng = random.Random(batches)
    lines = [f"Line {i} {'x' * (i % 9)}" for i in range(40)] + ["short", "", "  padded line of text  ", "PADDED line of text"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 8))), "en", "s", 0) for i in range(60)] + odd_rows()
    df = dedup_lines(with_clashes(spark.createDataFrame(rows, DOCS)), batches=batches, fanout=fanout)
    assert found(df) == brute(rows)


def test_keeps_named_columns_and_marks_emptied(spark):
    rows = [(1, "a line that repeats\nyes", "en", "s", 1), (2, "A LINE that repeats\nno", "de", "t", 2), (3, "only short", "fr", "u", 3)]
    df = dedup_lines(spark.createDataFrame(rows, DOCS), keep=("lang", "source"))
    got = {r.doc_id: (r.text, r.lang, r.source, r.emptied) for r in df.collect()}
    assert got == {1: (rows[0][1], "en", "s", False), 2: ("no", "de", "t", True), 3: ("only short", "fr", "u", False)}


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], DOCS)).collect() == []


def test_runs_are_disjoint_and_compacted(spark):
    runs = LineRuns(spark, fanout=2, buckets=2)
    for b in range(5):
        rows = [(b * 10 + i, f"common line {i % 4} of batch {b % 2}") for i in range(8)]
        runs.add_batch(line_keys(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]  # 5 = 1 + 4 batches
    held = [r.key for run in runs.runs() for r in run.collect()]
    assert len(held) == len(set(held)) == 8
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run")]


def test_a_shuffle_width_beyond_what_buckets_allow(spark):
    """At 400,000 shuffle partitions the runs take the 100,000 buckets that Spark allows (held to 8 here to write them)."""
    width = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "400000")
        assert LineRuns(spark).buckets == 100_000
        spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "8")
        runs = LineRuns(spark)
        rows = spark.createDataFrame([(1, "a line of text"), (2, "a line of text")], "doc_id long, text string")
        keys = line_keys(rows, "doc_id", "text").coalesce(1)
        spark.conf.set("spark.sql.shuffle.partitions", width)
        assert runs.buckets == 8 and [r.doc_id for r in runs.add_batch(keys).collect()] == [2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")


def test_query_against_its_sql(spark):
    name = "op1_line_dedup"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = con.execute(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, SF_SMALL).toPandas()
    pd.testing.assert_frame_equal(got.sort_values("doc_id", ignore_index=True)[list(want.columns)], want.sort_values("doc_id", ignore_index=True), check_dtype=False)


def test_kept_columns_may_have_any_other_name(spark):
    rows = [(1, "a line of some length\nanother", "en", "s", 0), (2, "a line of some length\nthird line here", "en", "s", 0)]
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.concat(F.lit(c), "doc_id") for c in ("gone", "key", "start")})
    got = {r.doc_id: r for r in dedup_lines(df, keep=("gone", "key", "start")).collect()}
    assert got[2].text == "third line here" and (got[2].gone, got[2].key, got[1].start) == ("gone2", "key2", "start1")
    with pytest.raises(ValueError, match="emptied"):
        dedup_lines(df, keep=("emptied",))
