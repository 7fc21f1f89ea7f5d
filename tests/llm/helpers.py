"""Small tables and brute-force versions for the training-data operators."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Columns whose names the operators use inside.
CLASHES = ("key", "gone", "owner", "node", "bands", "odd", "mark", "hash", "start", "size", "part", "learn", "tokens", "weight", "pass", "block", "slot", "score", "kind", "pos", "vec", "home", "n_words", "n_lines", "n_tokens")


def with_clashes(df):
    """The same rows with extra columns named like the operators' own."""
    return df.withColumns({c: F.lit(f"x-{c}") for c in CLASHES if c not in df.columns})


def ascii_lower(text: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in text)


def blank_words(text) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))


def alnum_words(text) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def shingles(text, size: int) -> frozenset:
    w = blank_words(text)
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(zip(*[w[i:] for i in range(size)], strict=False))


class Forest:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def near_copies(n_base: int = 12, copies: int = 8, words: int = 60, seed: int = 5):
    """Families of texts that differ in some words, around the similarity of 0.8."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows, doc = [], 0
    for _ in range(n_base):
        base = [rng.choice(vocabulary) for _ in range(words)]
        for k in range(copies):
            text = list(base)
            for _ in range(rng.randrange(0, 7) if k else 0):
                text[rng.randrange(words)] = rng.choice(vocabulary)
            rows.append((doc, " ".join(text), "en", f"s{doc % 3}", 0))
            doc += 1
    rng.shuffle(rows)
    return rows


def odd_rows():
    """Nulls, empty and blank texts, one word, a very long text, repeated rows, rows that share an id, no id."""
    long = "\n".join(f"line number {i % 700} of a very long text" for i in range(5000))
    return [
        (1, None, None, None, None),
        (2, "", "en", "s0", 0),
        (3, " \t\n\r ", "en", None, 5),
        (4, "word", "en", "s1", 4),
        (5, "WORD", "en", "s1", 4),
        (6, long, "en", "s0", len(long)),
        (7, "the same line here\nthe same line here\nshort", "en", "s0", 30),
        (7, "the same line here\nthe same line here\nshort", "en", "s0", 30),
        (8, "another text that is quite different from all", "de", "s2", 40),
        (8, "the same line here", "de", "s2", 40),
        (None, "the same line here\nno id at all, but a line", "de", "s2", 40),
        (None, None, None, None, None),
        (9, "The Same Line HERE  \nÄÖÜ äöü ßßßß ÄÖÜ", "de", "s2", 40),
        (10, "ÄÖÜ äöü ßßßß ÄÖÜ\n日本語のテキスト", "ja", "s3", 40),
    ]
