import corpus_pipeline
from tessera.llm.quality import THRESHOLD
from tests.conftest import SF_ORACLE
from tests.llm.helpers import DOCS
from tests.llm.test_decontaminate import brute as contamination
from tests.llm.test_line_dedup import brute as cut_lines
from tests.llm.test_minhash_dedup import brute as near


def rows_of(df):
    return [tuple(r) for r in df.select(*corpus_pipeline.COLUMNS).collect()]


def test_each_stage_against_brute_force(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    seen = [rows_of(docs)]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_ORACLE)
        if name != "mixing":
            assert out.columns == list(corpus_pipeline.COLUMNS)
        out.write.parquet(f"{tmp_dir}/{i}")
        docs = spark.read.parquet(f"{tmp_dir}/{i}")
        seen.append(rows_of(docs))
    start, good, lined, single, clean, mixed = seen
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    kept = {r[0] for r in good}
    assert sum(d in kept for d, q in labels.items() if q == 1) > 0.97 * sum(q == 1 for q in labels.values())
    assert sum(d in kept for d, q in labels.items() if q == 0) < 0.15 * sum(q == 0 for q in labels.values())

    want = {d: text for d, _, _, text in cut_lines([(r[0], r[1]) for r in good])}
    assert all(r[1] == want[r[0]] and r[4] == len(r[1]) for r in lined)
    gone = kept - {r[0] for r in lined}
    first = {}
    for doc, text, *_ in sorted(good):
        first.setdefault(text, doc)
    copies = {doc for doc, text, *_ in good if first[text] != doc and any(len(x.strip()) >= 10 for x in text.split("\n"))}
    assert copies and copies <= gone  # later exact copies have no line of their own

    groups = {d: k for d, _, _, k in near([(r[0], r[1]) for r in lined], 5)}
    assert {r[0] for r in single} == {d for d, k in groups.items() if k}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").select("item_id", "text").collect()]
    assert {r[0] for r in clean} == {d for d, _, _, _, bad in contamination([(r[0], r[1]) for r in single], items) if not bad}
    assert set(mixed) == set(clean) and len(mixed) >= len(clean)
    assert THRESHOLD == 0.3


def test_short_lines_of_a_document_stay_when_its_long_ones_go(spark):
    header = "a header line that is shared"
    rows = [(1, header), (2, f"{header}\nx = 1\ny = 2"), (3, f"{header}\nx = 1\ny = 2"), (4, f" {header.upper()}\n \t\n"), (5, header), (None, f"{header}\nz"), (6, None), (7, "x = 1"), (7, f"{header}\nx = 1\ny = 2"), (8, f"{header}\nÄ")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = corpus_pipeline.line_dedup_stage(spark, docs, "").select("doc_id", "text", "n_chars").collect()
    want = [(1, header), (2, "x = 1\ny = 2"), (None, f"{header}\nz"), (6, ""), (7, "x = 1"), (8, "Ä")]
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, t, len(t)) for i, t in want), key=str)


def test_near_dedup_drops_texts_not_ids(spark):
    text, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    near = text.replace("w30", "x")
    rows = [(1, text), (2, text), (2, other), (3, near), (4, other), (5, "alone"), (5, "alone"), (None, text), (None, None), (6, None), (6, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = corpus_pipeline.near_dedup_stage(spark, docs, "").select("doc_id", "text").collect()
    want = [(1, text), (2, other), (5, "alone"), (None, text), (None, None), (6, None)]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_run_gives_the_last_stage(spark):
    df = corpus_pipeline.run(spark, SF_ORACLE)
    assert {"doc_id", "text", "pass", "block", "slot"} <= set(df.columns) and df.count() > 0
