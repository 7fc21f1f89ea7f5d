import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import queries, token_count
from tessera.llm.token_count import TokenCounter, count_tokens
from tests.conftest import SF_ORACLE
from tests.llm.helpers import DOCS, odd_rows, with_clashes

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def counter():
    with open(PATH) as f:
        return TokenCounter(json.load(f))


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_random_texts(counter, library):
    rng = random.Random(4)
    pieces = [*" \n\t '`.,!<|>", "'s", "'ll", "'re", "'v", "don't", "é", "ß", "٣", "日本", "😀", " ", "　", "\x1c", "\x85", "12", "the", " of", "ing", "<|endoftext|>", "<|endof", "aaaa"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 40))) for _ in range(6000)]
    assert counter.count(texts).tolist() == library(texts)


def test_every_code_point_class(counter, library):
    texts = [f"a{c}b {c}{c}1 '{c}" for c in map(chr, [*range(0x3000), *range(0xFF00, 0x10000), *range(0x1F300, 0x1F700)])]
    assert counter.count(texts).tolist() == library(texts)


def test_long_words_and_runs(counter, library):
    texts = ["a" * 3000, "ab" * 900, " " * 700, "\n" * 131 + "x", "-=" * 400, "9" * 500, "é" * 300, "", "x" * 64, "x" * 65, "A" * 63 + " "]
    assert counter.count(texts).tolist() == library(texts)


def test_chunks_compose(counter):
    """Starts do not depend on how the text is cut into chunks."""
    text = "don't  stop 'til you're\n\n done, it's 12'30\" <x>" * 9
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    symbol = token_count.symbols(code, np.array([0]), counter.classes)
    want = token_count.word_starts(symbol, counter.to, counter.emit, chunk=len(text)).tolist()
    for chunk in (1, 2, 7, 64):
        assert token_count.word_starts(symbol, counter.to, counter.emit, chunk).tolist() == want


def test_bounded_memory_starts_anew(counter, library, monkeypatch):
    monkeypatch.setattr(token_count, "MAX_STATES", 50)
    monkeypatch.setattr(token_count, "MAX_WORDS", 20)
    texts = [f"some words number{i} and more{i * i}" for i in range(200)]
    for i in range(0, 200, 20):
        assert counter.count(texts[i : i + 20]).tolist() == library(texts[i : i + 20])


def test_operator_on_odd_rows(spark, library):
    rows = odd_rows()
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in count_tokens(with_clashes(spark.createDataFrame(rows, DOCS)), PATH).collect()), key=str)
    texts = [t or "" for _, t, *_ in rows]
    assert got == sorted(((d, len(t.encode()), n) for (d, *_), t, n in zip(rows, texts, library(texts), strict=True)), key=str)
    assert count_tokens(spark.createDataFrame([], DOCS), PATH).collect() == []


def test_query_against_the_library(spark, library):
    rows = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.queries()["op10_token_count"](spark, SF_ORACLE).collect()}
    for row, n in zip(rows, library([r.text or "" for r in rows]), strict=True):
        assert (got[row.doc_id].n_tokens, got[row.doc_id].over_limit) == (n, n > 512)
