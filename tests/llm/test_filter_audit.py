import random
import re
from itertools import permutations

import duckdb
import pandas as pd

from tessera.llm import queries
from tessera.llm.filter_audit import audit_filters, failing_ids
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOCS, odd_rows, with_clashes

LABELS = "doc_id long, quality int, toxic int"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(doc, text, owners):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        "D": re.search(r"[#$%&*|]", text) is not None,
        "E": doc is not None and owners.get(text, doc) < doc,
    }


def brute(rows, labels):
    """Every order applied filter by filter to the rows themselves."""
    owners = {}
    for doc, text, *_ in rows:
        if doc is not None:
            owners[text or ""] = min(doc, owners.get(text or "", doc))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    for part in {r[2] or "" for r in rows}:
        own = [(r[0], fails(r[0], r[1], owners)) for r in rows if (r[2] or "") == part]
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [r for r in left if r[1][x]]
                left = [r for r in left if not r[1][x]]
                out[part, "".join(order), step] = {
                    "kept": len(left), "removed": len(gone), "redundant": sum(r[1][x] for r in own) - len(gone),
                    "unique_fails": sum(r[1][x] and sum(r[1].values()) == 1 for r in own),
                    "good_lost": sum(r[0] in good for r in gone), "toxic_lost": sum(r[0] in toxic for r in gone),
                }
        for x in "ABCDE":
            keys = [k for k in out if k[0] == part and k[1][k[2] - 1] == x]
            total = sum(out[k]["removed"] for k in keys)
            for k in keys:
                out[k]["shapley"] = total
    return out


def found(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): {c: r[c] for c in COUNTS} for r in rows}
    assert len(out) == len(rows)
    return out


def made_rows(n, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        size = rng.choice([3, 150, 199, 200, 260])
        pool = [f"w{k}" for k in range(rng.choice([20, 400]))]
        words = [rng.choice(pool) for _ in range(size)]
        text = rng.choice([" ", "\n", " \t"]).join(words)
        text = text + rng.choice(["", " # note", " A&B"]) + rng.choice(["", " LOUD" * 40])
        rows.append((i, text, rng.choice(["en", "de", "", None]), "s", 0))
    rows += [(n + i, rows[rng.randrange(n)][1], rng.choice(["en", "fr"]), "s", 0) for i in range(n // 2)]
    return rows


def test_matches_brute_force_on_odd_rows(spark):
    rows = made_rows(60) + [(1000 + (d or 0) if d is not None else None, *rest) for d, *rest in odd_rows()]
    rows += [(1001, "a text of a shared id", "en", "s", 0), (None, "a text of a shared id", "en", "s", 0), (None, "a text of a shared id", "en", "s", 0)]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 90, 2)] + [(4, 1, 0), (4, 0, 1), (1007, 1, 1), (None, 1, 1), (77, None, None)]
    df = audit_filters(with_clashes(spark.createDataFrame(rows, DOCS)), with_clashes(spark.createDataFrame(labels, LABELS)))
    assert found(df) == brute(rows, labels)


def test_a_part_that_no_filter_touches_has_zeros(spark):
    text = " ".join(f"word{i}" for i in range(220))
    rows = [(1, text, "xx", "s", 0)]
    got = found(audit_filters(spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS)))
    assert len(got) == 600 and all(v == {**dict.fromkeys(COUNTS, 0), "kept": 1} for v in got.values())


def test_one_id_table_per_filter(spark):
    rows = made_rows(40)
    documents, failing = failing_ids(spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS))
    assert sorted(r["filter"] for r in failing.select("filter").distinct().collect()) == [1, 2, 4, 8, 16]
    assert failing.count() == failing.distinct().count() and documents.count() == len(rows)


def test_empty_table(spark):
    assert audit_filters(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).collect() == []


def test_query_against_its_sql(spark):
    name = "op12_filter_audit"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    want = con.execute(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, SF_SMALL).toPandas()
    by = ["part", "filter_order", "step"]
    pd.testing.assert_frame_equal(got.sort_values(by, ignore_index=True)[list(want.columns)], want.sort_values(by, ignore_index=True), check_dtype=False)
