import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import minhash_dedup as m
from tessera.llm import queries
from tessera.llm.minhash_dedup import near_duplicates
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOCS, Forest, near_copies, odd_rows, shingles, with_clashes


def brute(rows, size):
    sets = [shingles(t, size) for _, t, *_ in rows]
    forest = Forest(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= 80 * len(a | b):
                forest.join(i, j)
    low = {}
    for i, (doc, *_) in enumerate(rows):
        if doc is not None:
            r = forest.root(i)
            low[r] = min(doc, low.get(r, doc))
    out = []
    for i, (doc, *_) in enumerate(rows):
        c = low.get(forest.root(i)) if doc is not None else None
        out.append((doc, len(sets[i]), c, doc is None or c == doc))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("size,block", [(2, 512), (5, 512), (2, 3)])
def test_matches_brute_force(spark, size, block):
    rows = near_copies() + [(1000 + i, f"exact copy of this text number {i % 3} a b c d e f", "en", "s", 0) for i in range(30)]
    df = near_duplicates(with_clashes(spark.createDataFrame(rows, DOCS)), shingle_words=size, block=block)
    assert found(df) == brute(rows, size)


def test_odd_rows(spark):
    rows = odd_rows() * 2
    assert found(near_duplicates(spark.createDataFrame(rows, DOCS), shingle_words=2)) == brute(rows, 2)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_chain_through_buckets_that_no_hub_settles(spark):
    """A chain of texts, each close to its neighbours only, is one component."""
    w = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(w[i * 6 : i * 6 + 100]), "en", "s", 0) for i in range(40)]
    df = near_duplicates(spark.createDataFrame(rows, DOCS), shingle_words=2)
    assert found(df) == brute(rows, 2)
    assert {r.component_id for r in df.collect()} == {0}


def test_odd_sketch_estimates_high_similarities():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 1 << 63, 660, dtype=np.uint64)
        a, b = np.unique(pool[:600]), np.unique(pool[60:])
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = (np.frombuffer(m.odd_sketch(m.minhash(s)), np.uint64) for s in (a, b))
        errors.append(m.estimate(np.array([np.bitwise_count(x ^ y).sum()]))[0] - j)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_shingle_sets_have_the_right_sizes():
    texts = ["a b c a b", "a", "", None, "A  b\tc", "x y", "é É e"]
    got = [len(s) for s in m.shingle_sets(pa.array(texts), 2)]
    assert got == [len(shingles(t, 2)) for t in texts]


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries.queries()["op2_minhash_near_dedup"](spark, SF_SMALL)) == brute(rows, 2)


def test_marks_tell_rows_of_one_id_apart(spark):
    text, other = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    df = near_duplicates(spark.createDataFrame([(1, text), (2, text), (2, other), (None, text)], "doc_id long, text string"), mark=True)
    marks = {t: spark.createDataFrame([(t,)], "t string").selectExpr("xxhash64(t)").first()[0] for t in (text, other)}
    got = sorted(((r.doc_id, r.mark, r.kept) for r in df.collect()), key=str)
    assert got == sorted([(1, marks[text], True), (2, marks[text], False), (2, marks[other], True), (None, marks[text], True)], key=str)
