import random
import zlib

import numpy as np
import pytest

from tessera.llm import queries
from tessera.llm.quality import BLOCK, BYTE_CLASS, STRIDE, WIDTH, ByteConvNet, blocks, fit_quality, score_quality
from tests.conftest import SF_ORACLE
from tests.llm.helpers import DOCS, odd_rows, with_clashes

LABELS = "doc_id long, quality int, toxic int"


def joined(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])])


def toy(n=160, seed=1):
    rng = random.Random(seed)
    good = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) for _ in range(rng.randrange(5, 60)))
    bad = lambda: " ".join(rng.choice(["ALPHA!!", "###", "$$ $$", "BETA!!"]) for _ in range(rng.randrange(5, 60)))
    rows = [(i, good() if i % 2 else bad(), "en", "s", 0) for i in range(n)]
    return rows, [(i, i % 2, 0) for i in range(n)]


def test_scores_do_not_depend_on_the_batch():
    net, texts = ByteConvNet(), ["", "a", "b" * 500, "some text " * 90, "é" * 300, "x", "c" * 128, "d" * 126, "e" * 124, "f" * 125]
    together = net.score(*joined(texts))
    alone = [net.score(*joined([t]))[0] for t in texts]
    assert together == pytest.approx(alone, abs=1e-6)


def test_every_byte_is_seen():
    """A marker anywhere in a long text changes the pooled responses."""
    net = ByteConvNet()
    text = "a" * (BLOCK * STRIDE * 7 + 13)
    for at in [0, 1, 63, 127, 128, 500, len(text) - 3]:
        other = text[:at] + "#!#" + text[at + 3 :]
        c0, n0 = blocks(*joined([text]))
        c1, n1 = blocks(*joined([other]))
        assert (n0 == n1).all() and np.abs(net.pooled(c0, n0) - net.pooled(c1, n1)).max() > 0.1


def test_gradient_matches_differences():
    net, rng = ByteConvNet(3), np.random.default_rng(2)
    texts, labels = [bytes(rng.integers(32, 126, n, dtype=np.uint8)) for n in (5, 300, 700)], np.array([0, 1, 1], np.float32)
    grads = net._gradient(texts, labels)

    def loss():
        p = net.score(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
        return -np.mean(np.where(labels > 0, np.log(p), np.log(1 - p)))

    for param, grad in zip(net.params(), grads, strict=True):
        flat, at = param.reshape(-1), int(np.abs(grad).argmax())
        keep, step = flat[at], 1e-2
        flat[at] = keep + step
        up = loss()
        flat[at] = keep - step
        down = loss()
        flat[at] = keep
        assert (up - down) / (2 * step) == pytest.approx(grad.reshape(-1)[at], rel=0.15, abs=2e-3)


def test_learns_and_scores_all_rows(spark):
    rows, labels = toy()
    docs = with_clashes(spark.createDataFrame(rows + [(1000 + (r[0] or 0), *r[1:]) for r in odd_rows()], DOCS))
    net = fit_quality(docs, spark.createDataFrame(labels + [(5000, 1, 0), (None, 1, 0), (3, None, None)], LABELS))
    out = score_quality(docs, net).collect()
    assert len(out) == len(rows) + len(odd_rows()) and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.doc_id < 160 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all((r.score >= 0.3) == (r.doc_id % 2 == 1) for r in held) and held


def test_one_label_or_none_gives_a_constant(spark):
    docs = spark.createDataFrame(toy(20)[0], DOCS)
    for labels in ([], [(i, 1, 0) for i in range(20)]):
        net = fit_quality(docs, spark.createDataFrame(labels, LABELS))
        assert len({r.score for r in score_quality(docs, net).collect()}) == 1
    assert score_quality(docs.limit(0), net).collect() == []


def test_held_out_accuracy_of_the_query(spark):
    got = {r.doc_id: r for r in queries.queries()["op8_quality"](spark, SF_ORACLE).collect()}
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF_ORACLE}/documents.parquet").count()
    held = [(got[x.doc_id].predicted, x.quality) for x in labels if got[x.doc_id].held_out]
    assert len(held) > 40 and np.mean([p == q for p, q in held]) > 0.93
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())


def plain_score(net, text):
    """The network written out position by position."""
    data = text.encode()
    step, n = BLOCK * STRIDE, -(-(len(data) + WIDTH - STRIDE) // (BLOCK * STRIDE))
    classes = [int(BYTE_CLASS[b]) for b in data] + [0] * (n * step + WIDTH - len(data))
    pooled = []
    for block in range(n):
        places = BLOCK - (WIDTH - STRIDE) // STRIDE if block == n - 1 else BLOCK
        found = [sum(net.conv[j, classes[block * step + p * STRIDE + j]].astype(float) for j in range(WIDTH)) for p in range(places)]
        pooled.append(np.maximum(np.max(found, axis=0) + net.bias, 0))
    chunks = [np.maximum(pooled[i], pooled[min(i + 1, n - 1)]) for i in range(n)]
    x = np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0)])
    z = np.tanh(x @ net.w1.astype(float) + net.b1)
    return 1 / (1 + np.exp(-(z @ net.w2.astype(float) + net.b2[0] + net.shift)))


def test_scores_equal_the_plain_forward_pass():
    rng = random.Random(5)
    net = ByteConvNet(4)
    net.shift = 0.3
    texts = ["", "a", "é!", "x" * 124, "y" * 125, "z" * 128, *("".join(rng.choice("abc XYZ#,.\n19é") for _ in range(rng.randrange(1, 900))) for _ in range(20))]
    assert net.score(*joined(texts)) == pytest.approx([plain_score(net, t) for t in texts], abs=1e-5)


def test_a_very_long_text_needs_bounded_memory():
    import tracemalloc

    net, text = ByteConvNet(), "some words of a text, " * 800_000  # 17.6 MB
    data, offsets = joined([text])
    tables = net.tables()
    tracemalloc.start()
    score = net.score(data, offsets, tables)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 < score[0] < 1 and peak < 300e6


def test_rows_that_share_an_id_give_one_sample(spark):
    rows, labels = toy(60)
    labels = spark.createDataFrame(labels, LABELS)
    more = rows + [(d, f"other {t}", *rest) for d, t, *rest in rows for _ in range(6)]
    a = fit_quality(spark.createDataFrame(more, DOCS).repartition(7), labels)
    b = fit_quality(spark.createDataFrame(more[::-1], DOCS).repartition(3), labels)
    assert all((x == y).all() for x, y in zip(a.params(), b.params(), strict=True))
