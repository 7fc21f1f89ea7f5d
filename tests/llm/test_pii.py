import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import pii, queries
from tessera.llm.pii import BoostedTrees, base_spans, find_pii, fit_trees, luhn, redact, spell
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOCS, odd_rows, with_clashes

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if (
                kind == "email"
                or (kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")))
                or (kind == "card" and 13 <= len(d) <= 19 and luhn(d))
                or (kind == "phone" and 9 <= len(d) <= 15)
            ):
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(8)
    for _ in range(30000):
        text = "".join(rng.choice("ab12345678901@.@+- ()_%é") for _ in range(rng.randrange(0, 50)))
        assert base_spans(text) == brute(text), text
    for text in ["a@b@c.d", "a.b@c.d.e@f.g", "1.2.3.4.5.6.7.8", "4111 1111-1111 1111", "+1 (2) 3456 7890", "0" * 400, "1.2.3.256", "+" * 50, "@" * 50]:
        assert base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    for text in ["a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 100_000, "+1 " * 100_000, "1 " * 100_000]:
        base_spans(text)
        pii.candidates(text)


def test_spelled_local_parts_of_any_length():
    name = "long.local-part" * 20
    text = f"mail {name} at mail dot example dot com or x [at] y.org, and z at w dot net"
    got = [text[s:e] for k, s, e in pii.candidates(text) if k == "email"]
    assert got == [f"{name} at mail dot example dot com", "x [at] y.org", "z at w dot net"]


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def sample_docs(n=400, seed=3):
    rng = random.Random(seed)
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    rows = []
    for i in range(n):
        what = rng.choice([f"mail me at joe{i}@mail.example.com now", f"call +1 ({num(3)}) {num(3)}-{num(4)} today", f"server 10.{rng.randrange(256)}.3.{rng.randrange(256)} is up", f"order 9{num(7)} was shipped in {num(4)}", f"build 300.{num(3)}.999.{num(3)} failed"])
        rows.append((i, f"Some words before. {what}. Some words after.", "en", "s", 0))
    return rows


def test_trees_add_spans_and_leave_numbers_alone(spark):
    trees = fit_trees(spark.createDataFrame(sample_docs(), DOCS))
    rows = [(1, "please call (212) 555-0187 today", "en", "s", 0), (2, "order 91234567 was shipped in 2024", "en", "s", 0), (3, "plain words only", "en", "s", 0)]
    got = {r.doc_id: r for r in find_pii(spark.createDataFrame(rows, DOCS), trees, with_text=True).collect()}
    assert got[1].n_phone == 0 and got[1].spans == "phone:12:26" and got[1].redacted == "please call [PHONE] today"
    assert got[2].spans == "" and got[3].redacted == "plain words only"


def test_loose_data_in_the_training_texts_are_found(spark):
    """Half of the texts learned from hold data that no base rule takes."""
    rng = random.Random(4)
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    loose = [lambda: f"({num(3)}) {num(3)}-{num(4)}", lambda: f"{num(3)}-{num(3)}-{num(4)}", lambda: f"joe{num(2)} at mail dot example dot com", lambda: ":".join(f"{rng.randrange(1 << 16):x}" for _ in range(8))]
    rows = sample_docs(800) + [(1000 + i, f"Some words before. We had {rng.choice(loose)()} there. Some words after.", "en", "s", 0) for i in range(800)]
    trees = fit_trees(spark.createDataFrame(rows, DOCS))
    probe = {1: ("We had (212) 555-0187 there", "phone:7:21"), 2: ("We had joe at mail dot com there", "email:7:26"), 3: ("We had 2001:db8:85a3:11:2:8a2e:370:7334 there", "ip:7:39"), 4: ("order 91234567 was shipped in 2024", ""), 5: ("build 300.123.999.456 failed at 3.5 and 12:30:45:10", "")}
    got = {r.doc_id: r.spans for r in find_pii(spark.createDataFrame([(i, t, "en", "s", 0) for i, (t, _) in probe.items()], DOCS), trees).collect()}
    assert got == {i: want for i, (_, want) in probe.items()}


LOOK_ALIKES = [
    "the book ISBN 978-0-306-40615-7 is old", "ISBN-13: 978-3-16-148410-0", "runs version 10.0.19041.3803 now", "firmware 2.4.11872.5566 was out", "near lat 12 345 67 890 there",
    "coordinates 48 137 11 575 on the map", "see you at noon dot org or so", "we look at example.com daily", "it is available at the-site.org today", "order 4021-7789-113 was sent",
    "invoice 2210 8841 972 is due", "tracking 1234-5678-903 moved", "logged 2024-01-15 10:20:30 again", "dated 2019-12-05 23:59", "numbers 12 345, 44 120 31 555, 871 followed",
    "a population of 12 345 678 901 people", "mac 00:1a:2b:3c:4d:5e:6f:70 seen", "section 3 . 2 . 1 . 4 says", "order 4539.1488.0343.6467 shipped",
]


def test_the_trees_decide_among_candidates_of_sound_form(spark):
    """Look-alikes pass the check of their kind and are turned down; loose data of every kind are found."""
    rng = random.Random(12)
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    cards = [f"Some words before. paid by 4111 1111 1111 1111 at {num(2)} again. Some words after." for _ in range(200)]
    rows = sample_docs(900) + [(2000 + i, t, "en", "s", 0) for i, t in enumerate(cards)]
    trees = fit_trees(spark.createDataFrame(rows, DOCS))
    sound = sum(any(pii.well_formed(t, c) for c in pii.candidates(t)) for t in LOOK_ALIKES)
    assert sound >= 14  # a rule on form alone would take them
    wrong = [(t, pii.added_spans(t, base_spans(t), trees)) for t in LOOK_ALIKES if pii.added_spans(t, base_spans(t), trees)]
    loose = [
        lambda: f"({num(3)}) {num(3)}-{num(4)}", lambda: f"{num(3)}-{num(3)}-{num(4)}", lambda: f"joe{num(2)} at mail dot example dot com", lambda: f"ann.{num(2)} [at] site [dot] net",
        lambda: ":".join(f"{rng.randrange(1 << 12, 1 << 16):x}" for _ in range(8)),
    ]
    texts = [f"Some words before, and then {make()} came after it." for make in loose for _ in range(40)]
    found = [bool(pii.added_spans(t, base_spans(t), trees)) for t in texts]
    assert sum(found) >= 0.9 * len(texts)
    assert len(wrong) <= 0.02 * (sum(found) + len(wrong)), wrong  # precision of 98 %


def test_look_alikes_are_made_as_the_generators_find_them():
    rng = np.random.default_rng(3)
    text, spans = "mail joe7@mail.example.com or call +1 (212) 555-0187, host 10.1.2.3, card 4111 1111 1111 1111 today", {}
    for span in base_spans(text):
        for _ in range(200):
            other, start, end = pii.lookalike(text, span, rng)
            found = [c for c in pii.candidates(other) if c[1] < end and c[2] > start]
            spans.setdefault(span[0], []).append(any(pii.well_formed(other, c) for c in found))
    assert set(spans) == {"email", "ip", "card", "phone"} and all(np.mean(v) > 0.25 for v in spans.values())
    assert pii.book_number("9780306406157") and not pii.book_number("9780306406158") and not pii.book_number("1234567890128")


def test_well_formed_candidates_have_no_label():
    for text in ["x (212) 555-0187 y", "x joe at mail dot com y", "x joe [at] mail.com y", "x 4111.1111.1111.1111 y", "x 10 . 0 . 0 . 1 y", "x 1:2:3:4:5:6:7:8 y"]:
        assert pii.candidates(text) and not [y for _, y in pii.examples(text, 0) if y == 0 and "4111" not in text]
    for text in ["x 91234567 y", "x 4111.1111.1111.1112 y", "x 300 . 1 . 1 . 1 y", "look at example.com y", "x 2024-01-15 10:20 y", "x 12:30:45:10 y"]:
        assert 0 in [y for _, y in pii.examples(text, 0)]


def test_boosted_trees_learn_and_calibrate():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 10, (3000, 4)).astype(float)
    y = ((x[:, 1] > 4) ^ (x[:, 2] > 6)).astype(float)
    trees = BoostedTrees()
    trees.fit(x[:2000], y[:2000])
    p = trees.predict(x[2000:])
    assert ((p > 0.5) == (y[2000:] > 0)).mean() > 0.97
    trees.calibrate(np.zeros(1000, int), p, y[2000:], 0.98)
    chosen = p >= trees.floor["email"]
    assert y[2000:][chosen].mean() >= 0.98 and trees.floor["ip"] == 2.0


def test_odd_rows_empty_table_and_nothing_to_learn(spark):
    docs = with_clashes(spark.createDataFrame(odd_rows() + [(20, "x@y.zz " * 3000, "en", "s", 0)], DOCS))
    trees = fit_trees(docs.limit(0))
    got = find_pii(docs, trees).collect()
    assert len(got) == len(odd_rows()) + 1
    assert sorted(r.n_email for r in got)[-1] == 3000
    assert find_pii(docs.limit(0), trees).collect() == []


def test_redact_merges_overlaps():
    assert redact("abcdef", [("ip", 1, 3), ("card", 2, 5)]) == "a[IP]f"


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.queries()["op6_pii"](spark, SF_SMALL).collect()}
    for doc, text in rows:
        base = brute(text)
        assert got[doc].base_sha256 == hashlib.sha256(spell(base).encode()).hexdigest()
        assert [got[doc][f"n_{k}"] for k in PATTERNS] == [sum(b[0] == k for b in base) for k in PATTERNS]
        assert {f"{k}:{s}:{e}" for k, s, e in base} <= set(got[doc].spans.split(",")) | ({""} if not base else set())


def test_every_document_is_learned_from(spark, monkeypatch):
    """One document in a hundred holds a shape of its own; cuts, sums and thresholds are those of all examples, in numpy."""
    rows = sample_docs(3000, seed=9)
    rows = [(i, f"order {i} 12.34.56.{300 + i} failed" if i % 100 == 0 else t, *rest) for i, t, *rest in rows]
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    monkeypatch.setattr(pii, "TREES", 4)
    monkeypatch.setattr(pii, "TASK_ROWS", 2000)
    trees = fit_trees(docs)
    every = [(x, y, seed % 10) for i, t, *_ in rows for seed in [zlib.crc32(str(i).encode())] for x, y in pii.examples(t, seed)]
    x, y, part = (np.array(v, float) for v in zip(*every, strict=True))
    assert len(y) > 3 * pii.TASK_ROWS and pii.all_examples(docs).count() == len(y)
    plain = BoostedTrees()
    plain.fit(x[part < 7], y[part < 7])
    plain.calibrate(x[part >= 7, 0].astype(int), plain.predict(x[part >= 7]), y[part >= 7], pii.PRECISION)
    assert all(np.allclose(a, b) for a, b in zip(trees.cuts, plain.cuts, strict=True)) and np.isclose(trees.base, plain.base)
    assert len(trees.trees) == 4 and all(np.allclose(a, b) for one, other in zip(trees.trees, plain.trees, strict=True) for a, b in zip(one, other, strict=True))
    assert trees.floor == plain.floor and min(plain.floor.values()) <= 1


def test_documents_outside_the_former_sample_are_learned_from(spark):
    """60,000 documents; a sample of a third, by hash of the id, held no personal data at all."""
    some = F.pmod(F.xxhash64("doc_id", F.lit("pii")), F.lit(3)) != 0
    call = F.concat(F.lit("call +1 (212) 555-"), F.lpad(F.col("doc_id").cast("string"), 4, "0"), F.lit(" today"))
    docs = spark.range(60_000).select(F.col("id").alias("doc_id")).withColumn("text", F.when(some & (F.col("doc_id") < 1200), call).otherwise("plain words"))
    trees = fit_trees(docs)
    assert trees.floor["phone"] <= 1 and trees.floor["card"] == 2.0
    text = "please call 212-555-0187 today"
    assert spell(pii.added_spans(text, [], trees)) == "phone:12:24"


def test_one_text_may_give_more_than_a_batch(spark, monkeypatch):
    monkeypatch.setattr(pii, "BATCH_ROWS", 100)
    docs = spark.createDataFrame([(1, "x@y.zz " * 300), (2, None), (None, "a@b.cc"), (None, "a@b.cc")], "doc_id long, text string")
    got = pii.all_examples(docs)
    want = sum(len(list(pii.examples(t, zlib.crc32(seed)))) for t, seed in [("x@y.zz " * 300, b"1"), ("a@b.cc", b""), ("a@b.cc", b"")])
    assert got.where("y = 1").count() == 2 * 302 and got.count() == want


def test_counted_rows_calibrate_as_single_ones():
    rng = np.random.default_rng(5)
    p, kind = rng.integers(40, 100, 4000) / 100, rng.integers(0, 4, 4000)
    y = (rng.random(4000) < np.where(p > 0.7, 0.995, 0.6)).astype(int)
    one, other = BoostedTrees(), BoostedTrees()
    one.calibrate(kind, p, y, 0.98)
    keys, at = np.unique(np.stack([kind, p]), axis=1, return_inverse=True)
    other.calibrate(keys[0].astype(int), keys[1], np.bincount(at.ravel(), y), 0.98, np.bincount(at.ravel()))
    assert one.floor == other.floor and min(one.floor.values()) < 1
