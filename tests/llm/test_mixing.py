import math
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.llm import queries
from tessera.llm.mixing import mix_sources, source_plan
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOCS, blank_words, odd_rows, with_clashes


def skewed(n=240, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{i % 7}" if i % 5 else None
        rows.append((i, " ".join("w" for _ in range(rng.randrange(0, 40))), "en", source, 0))
    return rows


def plan(spark, sizes: dict, **options):
    rows = [(s, n) for s, n in sizes.items()]
    return {r.source: r for r in source_plan(spark.createDataFrame(rows, "source string, n_tokens long"), **options).collect()}


def entropy(weights):
    return -sum(w * math.log(w) for w in weights if w)


def test_exponent_meets_the_target_entropy(spark):
    sizes = {"hot": 6000, "a": 1500, "b": 1200, "c": 1300}
    got = plan(spark, sizes, target_entropy=0.95, max_passes=100.0)
    assert entropy([r.weight for r in got.values()]) / math.log(4) == pytest.approx(0.95, abs=1e-4)
    assert got["hot"].budget == 6000 and all(r.budget >= r.tokens for r in got.values())
    # Shares are powers of the token shares.
    a = math.log(got["a"].weight / got["hot"].weight) / math.log(1500 / 6000)
    assert a == pytest.approx(math.log(got["b"].weight / got["hot"].weight) / math.log(1200 / 6000), abs=1e-3)


@pytest.mark.parametrize("target", [0.9, 0.97, 0.999])
def test_exponent_against_plain_bisection(spark, target):
    """Thousands of sources, many of them alike in size: the exponent is what plain halving gives."""
    rng = random.Random(8)
    sizes = [int(rng.paretovariate(0.7) * 10) + 1 for _ in range(3000)]
    got = plan(spark, {f"s{i}": n for i, n in enumerate(sizes)}, target_entropy=target, max_passes=1e12)
    lo, hi, total = 0.0, 1.0, sum(sizes)
    for _ in range(40):
        a = (lo + hi) / 2
        z = math.fsum((n / total) ** a for n in sizes)
        lo, hi = (a, hi) if entropy([(n / total) ** a / z for n in sizes]) >= target * math.log(len(sizes)) else (lo, a)
    most = max(sizes)
    for i, n in enumerate(sizes):
        assert got[f"s{i}"].budget == pytest.approx(most * (n / most) ** round(lo, 6), abs=0.51)


def test_last_pass_of_many_blocks_takes_them_in_order(spark):
    """Blocks of one document, over many slices of the order: the budget is met by a prefix of the permutation."""
    rows = [(i, "w", "en", "big", 0) for i in range(900)] + [(2000 + i, "w", "en", "small", 0) for i in range(500)]
    got = mix_sources(spark.createDataFrame(rows, DOCS), block_tokens=1, target_entropy=1.0, max_passes=3.0).where("source = 'small'").collect()
    per = {r.doc_id for r in got if r["pass"] == 0}
    last = {r.doc_id for r in got if r["pass"] == 1}
    assert len(per) == 500 and len(last) == pytest.approx(400, abs=5) and last < per


def test_repetitions_are_limited(spark):
    got = plan(spark, {"hot": 100000, "tiny": 100}, target_entropy=1.0, max_passes=3.0)
    assert got["tiny"].budget == pytest.approx(300, abs=2)


def test_even_sources_are_left_as_they_are(spark):
    got = plan(spark, {"a": 10, "b": 10, "none": 0})
    assert {s: (r.budget, r.full_passes, r.rest) for s, r in got.items()} == {"a": (10, 1, 0), "b": (10, 1, 0), "none": (0, 1, 0)}


def test_total_budget_is_shared_by_weight(spark):
    got = plan(spark, {"a": 900, "b": 100}, target_entropy=0.0, total_tokens=500)
    assert (got["a"].budget, got["b"].budget) == (450, 50)


@pytest.mark.parametrize("block_tokens", [50, 1_000_000])
def test_budgets_are_met_by_whole_blocks_and_one_cut_block(spark, block_tokens):
    rows = skewed() + [(100 + i, *r[1:]) for i, r in enumerate(odd_rows()) if r[0] != 6]
    df = mix_sources(with_clashes(spark.createDataFrame(rows, DOCS)), block_tokens=block_tokens, target_entropy=0.97)
    got = df.collect()
    tokens, most = {}, {}
    for _, text, _, source, _ in rows:
        n = len(blank_words(text))
        tokens[source] = tokens.get(source, 0) + n
        most[source] = max(n, most.get(source, 0))
    wanted = {r.source: r for r in source_plan(spark.createDataFrame([(r[3], len(blank_words(r[1]))) for r in rows], "source string, n_tokens long"), block_tokens=block_tokens, target_entropy=0.97).collect()}
    for source, total in tokens.items():
        own = [r for r in got if r.source == source]
        for p in range(wanted[source].full_passes):  # whole passes hold every row
            assert sum(r["pass"] == p for r in own) == sum(x[3] == source for x in rows)
        spent = sum(r.n_tokens for r in own)
        assert wanted[source].budget <= spent < wanted[source].budget + max(1, most[source]) or total == 0
        last = sorted({(r.block) for r in own if r["pass"] == wanted[source].full_passes})
        every = sorted({r.block for r in own if r["pass"] == 0})
        assert len(last) <= len(every)
    assert {str(r.doc_id) for r in got} == {str(x[0]) for x in rows}  # no document is left out


def test_passes_have_their_own_permutations(spark):
    rows = [(i, "a b c", "en", "big" if i < 90 else "small", 0) for i in range(100)]
    got = mix_sources(spark.createDataFrame(rows, DOCS), target_entropy=1.0, max_passes=3.0).where("source = 'small'").collect()
    order = {p: [r.doc_id for r in sorted(got, key=lambda r: (r.block, r.slot)) if r["pass"] == p] for p in (0, 1)}
    assert sorted(order[0]) == sorted(order[1]) and order[0] != order[1]


def test_keep_carries_columns_and_empty_table(spark):
    df = mix_sources(spark.createDataFrame(skewed(20), DOCS), keep=("text", "lang"))
    assert {r.text for r in df.collect()} == {r[1] for r in skewed(20)}
    assert mix_sources(spark.createDataFrame([], DOCS)).collect() == []


def test_kept_columns_may_have_any_other_name(spark):
    inner = ("home", "rest", "blocks", "left", "n", "before", "full_passes", "order", "slice")
    df = spark.createDataFrame(skewed(40), DOCS).withColumns({c: F.concat(F.lit(c), "doc_id") for c in inner})
    got = mix_sources(df, keep=inner).collect()
    assert got and all(r[c] == f"{c}{r.doc_id}" for r in got for c in inner)
    with pytest.raises(ValueError, match="block"):
        mix_sources(df.withColumn("block", F.lit(1)), keep=("block",))


def test_no_python_in_the_plan(spark):
    df = mix_sources(spark.createDataFrame(skewed(20), DOCS))
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()


def test_query_and_a_skewed_table_against_the_sql(spark, tmp_dir):
    spark.createDataFrame(skewed(), DOCS).coalesce(1).write.parquet(f"{tmp_dir}/documents.parquet")
    for folder, files in ((SF_SMALL, f"{SF_SMALL}/documents.parquet"), (tmp_dir, f"{tmp_dir}/documents.parquet/*.parquet")):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{files}'")
        want = con.execute(queries.oracle_sql()["op5_mix_sources"]).df()
        got = queries.queries()["op5_mix_sources"](spark, folder).toPandas()
        by = ["doc_id", "pass"]
        pd.testing.assert_frame_equal(got.sort_values(by, ignore_index=True)[list(want.columns)], want.sort_values(by, ignore_index=True), check_dtype=False)
    assert (got["pass"] > 0).any()
