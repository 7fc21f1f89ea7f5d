import random

import duckdb
import pandas as pd
import pytest

from tessera.llm import queries
from tessera.llm.decontaminate import drop_contaminated, find_contamination
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOCS, alnum_words, odd_rows, with_clashes

ITEMS = "item_id long, text string"


def brute(rows, items):
    windows = {}
    for item, text in items:
        w = alnum_words(text)
        if item is not None and w:
            n = min(10, len(w))
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc, text, *_ in rows:
        w, hit, own = alnum_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    own |= windows[k]
        out.append((doc, len(w), len(hit), tuple(sorted(own)), bool(hit)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in df.collect()), key=str)


def table(seed=3):
    rng = random.Random(seed)
    v = [f"v{i}" for i in range(30)]
    passages = [[rng.choice(v) for _ in range(rng.choice([3, 6, 9, 10, 11, 25]))] for _ in range(14)]
    items = [(i, " ".join(p).upper()) for i, p in enumerate(passages)] + [(3, " ".join(passages[3])), (50, passages and " ".join(passages[5])), (None, "a b c"), (51, None), (52, " . ")]
    rows = []
    for i in range(120):
        text = [rng.choice(v) for _ in range(rng.randrange(0, 60))]
        p = rng.choice(passages)
        a, b = sorted(rng.sample(range(len(p) + 1), 2))
        rows.append((i, ", ".join(text[:10] + p[a:b] + text[10:]), "en", "s", 0))
    return rows + odd_rows(), items


@pytest.mark.parametrize("per_pass", [1_000_000, 7])
def test_matches_brute_force_in_any_number_of_passes(spark, per_pass):
    rows, items = table()
    df = find_contamination(with_clashes(spark.createDataFrame(rows, DOCS)), spark.createDataFrame(items, ITEMS), grams_per_pass=per_pass)
    assert found(df) == brute(rows, items)


def test_every_shared_run_of_ten_words_is_found(spark):
    rng = random.Random(9)
    item = [f"i{k}" for k in range(60)]
    rows = []
    for i in range(51):
        n = rng.randrange(5, 30)
        rows.append((i, " ".join([f"d{rng.randrange(50)}" for _ in range(n)] + item[i : i + 10] + ["tail"] * n), "en", "s", 0))
    df = find_contamination(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(1, " ".join(item))], ITEMS))
    assert {(r.doc_id, r.n_hit) for r in df.collect()} == {(i, 10) for i in range(51)}


def test_drop_keeps_clean_rows_and_all_columns(spark):
    rows, items = table(4)
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    left = drop_contaminated(docs, spark.createDataFrame(items, ITEMS))
    assert left.columns == docs.columns
    assert sorted((str(r.doc_id) for r in left.collect())) == sorted(str(d) for d, _, _, _, bad in brute(rows, items) if not bad)


def test_empty_tables(spark):
    docs, none = spark.createDataFrame(odd_rows(), DOCS), spark.createDataFrame([], ITEMS)
    assert not any(r.contaminated for r in find_contamination(docs, none).collect())
    assert find_contamination(docs.limit(0), spark.createDataFrame([(1, "a b")], ITEMS)).collect() == []


def test_query_against_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    want = con.execute(queries.oracle_sql()["op7_decontaminate"]).df()
    got = queries.queries()["op7_decontaminate"](spark, SF_SMALL).toPandas()
    pd.testing.assert_frame_equal(got.sort_values("doc_id", ignore_index=True)[list(want.columns)], want.sort_values("doc_id", ignore_index=True), check_dtype=False)
    assert got.contaminated.any()
