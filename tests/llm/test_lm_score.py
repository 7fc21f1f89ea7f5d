import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import lm_score, queries
from tessera.llm.lm_score import score_texts
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOCS, blank_words, odd_rows, with_clashes


def learned(doc):
    return doc is None or zlib.crc32(str(doc).encode()) % 7 != 2


def brute(rows):
    count = collections.Counter()
    tokens = [[*blank_words(text), None] for _, text, *_ in rows]
    for (doc, *_), t in zip(rows, tokens, strict=True):
        if learned(doc):
            count.update(t)
    n, v = sum(count.values()), len(count)
    out = []
    for (doc, *_), t in zip(rows, tokens, strict=True):
        out.append((doc, len(t), sum(count[w] > 0 for w in t), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), 6)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=str)


def condition():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2


@pytest.mark.parametrize("max_words", [1_000_000, 40, 1])
def test_base_scores_are_exact_however_few_words_tasks_hold(spark, max_words):
    rows = [(100 + i, " ".join(f"w{(i * j) % 37}" for j in range(i % 25)) + f" only{i}", "en", "s", 0) for i in range(120)] + odd_rows()
    df = score_texts(with_clashes(spark.createDataFrame(rows, DOCS)), condition(), max_words=max_words, rounds=1)
    got = found(df)
    want = brute(rows)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want], abs=1e-5)


def test_probabilities_of_all_words_sum_to_one(spark):
    """Over every known word, the end and one unknown word, in any context."""
    rows = [(i, "a b c a b d e" if i % 2 else "b a f", "en", "s", 0) for i in range(40)]
    words = ["a", "b", "c", "d", "e", "f", "unknown"]
    texts = [*[f"a b {w}" for w in words], "a b"]
    probe = [(1000 + i, t, "en", "s", 0) for i, t in enumerate(texts)]
    df = score_texts(spark.createDataFrame(rows + probe, DOCS), F.col("doc_id") < 1000, rounds=1)
    score = {r.doc_id: r.score for r in df.collect()}
    whole = {t: score[1000 + i] for i, t in enumerate(texts)}
    vocab, _ = lm_score.read_vocabulary(spark.createDataFrame(rows, DOCS).select("text"))
    weights, bias = lm_score.train(spark.createDataFrame(rows, DOCS).select("text", F.lit(0).alias("part")), vocab, 1)
    seq, _, place = lm_score.sequences(pa.array(["a b x"]))
    _, cls = vocab.look_up(seq)
    p = lm_score.class_probabilities(weights, bias, lm_score.features(seq, place, cls))
    assert p.sum(axis=1) == pytest.approx(np.ones(len(seq)), abs=1e-5)
    # p(word | class) sums to one in each class that has words; unknown words share the rare class.
    inside = np.bincount(vocab.classes, weights=vocab.counts + 1, minlength=lm_score.CLASSES)
    inside[lm_score.RARE_CLASS] += 1
    assert inside[inside > 0] == pytest.approx(vocab.class_mass[inside > 0])
    assert all(v < 0 for v in whole.values())


def plain_model(parts, rounds):
    """The model in plain loops, for texts whose words are all held: ``parts (text, round)``; a function that scores a text."""
    classes, end = lm_score.CLASSES, int(lm_score.END)

    def tokens(text):
        return [int(h) for h in lm_score.sequences(pa.array([text]))[0]]

    count = collections.Counter(t for text, _ in parts for t in tokens(text))
    total, mass, cls = sum(count.values()), 0, {}
    for t in sorted(count, key=lambda t: (-count[t], t)):
        cls[t] = 1 + min(mass * (classes - 2) // total, classes - 3)
        mass += count[t]
    cls[end] = lm_score.END_CLASS
    inside, size = [0] * classes, [0] * classes
    for t, n in count.items():
        inside[cls[t]] += n
        size[cls[t]] += n + 1
    size[lm_score.RARE_CLASS] += 1
    prior = [(n + 1) / (total + classes) for n in inside]
    weights = collections.defaultdict(lambda: [0.0] * classes)

    def h(x):
        return int(lm_score.mix(np.array([x % 2**64], np.uint64))[0])

    def steps(text):
        """(token, its feature rows, its class probabilities) along the text."""
        seq = tokens(text)
        for i, t in enumerate(seq):
            one, two = (seq[i - k] if i >= k else int(lm_score.BEGIN) for k in (1, 2))
            c1, c2 = (cls.get(seq[i - k], lm_score.RARE_CLASS) if i >= k else lm_score.END_CLASS for k in (1, 2))
            hashed = [h(one ^ 1), h(two ^ 2), h(one * 3 + h(two))]
            rows = [("one", hashed[0] % lm_score.ROWS[0]), ("two", hashed[1] % lm_score.ROWS[1]), ("both", hashed[2] % lm_score.ROWS[2]), ("classes", c1, c2)]
            z = [math.exp(math.log(prior[c]) + sum(weights[r][c] for r in rows)) for c in range(classes)]
            yield t, rows, [x / sum(z) for x in z]

    for k in range(rounds):
        gradient, seen = collections.defaultdict(lambda: [0.0] * classes), collections.Counter()
        for text, part in parts:
            for t, rows, p in steps(text) if part == k else ():
                for r in rows:
                    seen[r] += 1
                    for c in range(classes):
                        gradient[r][c] += (c == cls[t]) - p[c]
        for r, g in gradient.items():
            weights[r] = [w + lm_score.RATE * x / (seen[r] * q * (1 - q) + 2.0) for w, x, q in zip(weights[r], g, prior, strict=True)]

    def score(text):
        own = [(cls.get(t, lm_score.RARE_CLASS), count[t], p) for t, _, p in steps(text)]
        return sum(math.log10((n + 1) * p[c] / size[c]) for c, n, p in own)

    return score


@pytest.mark.parametrize("rounds", [1, 3])
def test_score_against_the_model_in_plain_loops(spark, rounds):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{(7 * i + j * j) % 23 if j % 3 else int(rng.integers(60))}" for j in range(i % 19)), "en", "s", 0) for i in range(60)]
    rows += [(100, None, "en", "s", 0), (101, "never seen w1 w2 words", "en", "s", 0), (102, "w1 w2 w3", "en", "s", 0)]
    df = spark.createDataFrame(rows, DOCS)
    part = {r.doc_id: r.part for r in df.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(rounds)).alias("part")).collect()}
    score = plain_model([(text or "", part[d]) for d, text, *_ in rows if d < 100], rounds)
    got = {r.doc_id: r.score for r in score_texts(df, F.col("doc_id") < 100, rounds=rounds).collect()}
    for d, text, *_ in rows:
        assert got[d] == pytest.approx(score(text or ""), rel=1e-4), d


def test_context_helps_on_held_out_texts(spark):
    rows = [(i, " ".join(["red", "house", "green", "tree"] * (3 + i % 4)), "en", "s", 0) for i in range(300)]
    got = score_texts(spark.createDataFrame(rows, DOCS), F.col("doc_id") % 5 != 0).where("doc_id % 5 = 0").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got.s > 0.15 * got.b  # both are negative


def test_nothing_to_learn_from_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s", 0), (2, None, "en", "s", 0)], DOCS)
    got = {r.doc_id: r for r in score_texts(docs, F.lit(False)).collect()}
    assert (got[1].n_tokens, got[1].n_known, got[1].train_tokens, got[1].base_score) == (3, 0, 0, 0.0)
    assert score_texts(docs.limit(0), F.lit(True)).collect() == []


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.queries()["op9_lm_score"](spark, SF_SMALL)
    got, want = found(out), brute(rows)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want], abs=1e-4)
    assert all(r.held_out != learned(r.doc_id) and r.score < 0 for r in out.collect())
