"""Token counts by finite-state transducers compiled from a byte-level BPE vocabulary.

Two transducers follow each other.

* The splitter is a small deterministic machine over character classes (with
  the lookahead that the split pattern needs folded into the input symbols).
  The state map of every chunk of characters is composed by a parallel prefix
  scan, which gives each chunk its entry state; a second sweep emits the word
  starts.  All sweeps are numpy steps over all chunks at once.
* The word machine reads a word's bytes.  Its states are the byte prefixes,
  its transitions carry the change in the number of emitted tokens, and they
  are compiled when first taken: the last token of a prefix is the one suffix
  token that is compatible with the last token of what stands before it.

Special strings inside a text count as one token and end the words around them.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship_package, text_slices
from tessera.llm.text import U64, mix, powers

CHUNK = 64
MAX_STATES, MAX_WORDS = 200_000, 1_000_000  # bounds of what a worker remembers; beyond them it starts anew

# Character classes.
OTHER, LETTER, NUMBER, SPACE, BLANK = range(5)
# Input symbols of the splitter (+ SYMBOLS: the same at the start of a text).
S_LETTER, S_NUMBER, S_OTHER, S_QUOTE1, S_QUOTE2, S_RUN, S_JOIN, S_LAST, S_PAD = range(9)
SYMBOLS = 9
# States of the splitter, named by what was read last.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_JOIN, IN_RUN, AFTER_LAST, NEED1, NEED2, AFTER_QUOTE = range(10)
STATES = 10
# White space of the split pattern besides space, and the letters after an apostrophe.
BLANKS = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")


def char_classes() -> np.ndarray:
    """Class of every code point, by its Unicode category."""
    out = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LN":
            out[c] = LETTER if kind == "L" else NUMBER
    out[BLANKS], out[0x20] = BLANK, SPACE
    return out


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, 1 where a word starts) by state and symbol."""
    to, emit = np.zeros((STATES, 2 * SYMBOLS), np.uint8), np.zeros((STATES, 2 * SYMBOLS), np.uint8)
    for state in range(STATES):
        for symbol in range(2 * SYMBOLS):
            at, kind = (START, symbol - SYMBOLS) if symbol >= SYMBOLS else (state, symbol)
            goes, new = {
                S_LETTER: (IN_LETTERS, at not in (IN_LETTERS, AFTER_JOIN)),
                S_NUMBER: (IN_NUMBERS, at not in (IN_NUMBERS, AFTER_JOIN)),
                S_OTHER: (IN_OTHERS, at not in (IN_OTHERS, AFTER_JOIN)),
                S_QUOTE1: (NEED1, True),
                S_QUOTE2: (NEED2, True),
                S_RUN: (IN_RUN, at != IN_RUN),
                S_JOIN: (AFTER_JOIN, True),
                S_LAST: (AFTER_LAST, True),
                S_PAD: (at, False),
            }[kind]
            if kind in (S_QUOTE1, S_QUOTE2) and at in (IN_OTHERS, AFTER_JOIN):
                goes, new = IN_OTHERS, False
            if kind == S_LETTER and at in (NEED1, NEED2):
                goes, new = (AFTER_QUOTE if at == NEED1 else NEED1), False
            to[state, symbol], emit[state, symbol] = goes, new
    return to, emit


def symbols(code: np.ndarray, begins: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Input symbols of all characters; ``begins`` are the places where a text begins (none of them empty)."""
    n = len(code)
    kind = classes[code]
    last = np.zeros(n, dtype=bool)  # last character of its text
    last[begins[1:] - 1] = True
    last[-1] = True
    blank = kind >= SPACE
    before_word = np.zeros(n, dtype=bool)
    before_word[:-1] = ~blank[1:]
    before_word &= ~last
    out = kind.copy()
    out[kind == LETTER], out[kind == NUMBER], out[kind == OTHER] = S_LETTER, S_NUMBER, S_OTHER
    out[blank] = S_RUN
    out[blank & before_word] = S_LAST
    out[(kind == SPACE) & before_word] = S_JOIN
    quote = np.flatnonzero((code == 0x27) & ~last)
    if len(quote):
        after = code[quote + 1]
        one = np.isin(after, [ord(c) for c in SHORT_ENDINGS])
        out[quote[one]] = S_QUOTE1
        more = quote[~one & ~last[quote + 1]]
        pair = [(ord(a), ord(b)) for a, b in LONG_ENDINGS]
        two = np.zeros(len(more), dtype=bool)
        for a, b in pair:
            two |= (code[more + 1] == a) & (code[more + 2] == b)
        out[more[two]] = S_QUOTE2
    out[begins] += SYMBOLS
    return out


def word_starts(symbol: np.ndarray, to: np.ndarray, emit: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Places where words start: state maps per chunk, prefix scan, then one sweep from the known entry states."""
    n = len(symbol)
    rows = -(-n // chunk)
    grid = np.full(rows * chunk, S_PAD, dtype=np.uint8)
    grid[:n] = symbol
    grid = np.ascontiguousarray(grid.reshape(rows, chunk).T)
    flat, width = to.ravel(), 2 * SYMBOLS
    maps = np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], rows, axis=1)
    for column in grid:
        maps = flat[maps.astype(np.uint16) * width + column]
    step = 1  # maps[:, i] becomes the map of all chunks up to i
    while step < rows:
        maps[:, step:] = maps[maps[:, :-step], np.arange(step, rows)]
        step *= 2
    state = np.empty(rows, dtype=np.uint8)
    state[0], state[1:] = START, maps[START, :-1]
    starts, out = np.empty_like(grid), emit.ravel()
    for j, column in enumerate(grid):
        key = state.astype(np.uint16) * width + column
        starts[j], state = out[key], flat[key]
    return np.flatnonzero(starts.T.ravel()[:n])


class WordMachine:
    """Token counts of words, by transitions compiled when first taken.

    Tokens are numbers here.  Two neighbouring tokens are compatible if their
    joint text is encoded as just these two.  That is so unless some piece at
    the right edge of the first and some piece at the left edge of the second
    would merge while both stand: a piece stands from the rank that forms it
    until the rank that merges it into the next larger piece of its edge.
    (Ranks rise from the pieces to the whole, as in every trained vocabulary.)
    """

    def __init__(self, definition: dict):
        model = definition["model"]
        back = {u: b for b, u in _byte_units().items()}
        number = {t: i for i, t in enumerate(t for t in model["vocab"] if all(c in back for c in t))}
        self.size = len(number)
        self.single = {back[t]: i for t, i in number.items() if len(t) == 1}
        self.rank: dict[int, tuple[int, int]] = {}  # first * size + second -> (rank, merged token)
        self.parts: dict[int, tuple[int, int, int]] = {}  # token -> (rank, first, second)
        for rank, m in enumerate(model["merges"]):
            x, y = m.split(" ") if isinstance(m, str) else m
            x, y, whole = number[x], number[y], number[x + y]
            self.rank.setdefault(x * self.size + y, (rank, whole))
            self.parts.setdefault(whole, (rank, x, y))
        self.bytes_of = {i: bytes(back[c] for c in t) for t, i in number.items()}
        self.behind: dict[int, int] = {}  # reversed spelling of the tokens: node * 256 + byte -> node
        self.ends: dict[int, int] = {}
        free = 1
        for i, t in self.bytes_of.items():
            node = 0
            for byte in reversed(t):
                key = node * 256 + byte
                if key not in self.behind:
                    self.behind[key] = free
                    free += 1
                node = self.behind[key]
            self.ends[node] = i
        self.fits: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.clear()

    def clear(self) -> None:
        self.next: dict[int, int] = {}  # state * 256 + byte -> state
        self.last: list[int] = [-1]  # last token of the state's prefix
        self.emitted: list[int] = [0]  # tokens of the prefix

    def _is_whole(self, token: int) -> bool:
        """Whether the token's own text is encoded as this token (plain merges, once per token)."""
        if token not in self.whole:
            parts = [self.single[b] for b in self.bytes_of[token]]
            while len(parts) > 1:
                pairs = [(self.rank.get(x * self.size + y, (1 << 30, -1)), i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False))]
                (rank, whole), i = min(pairs)
                if rank == 1 << 30:
                    break
                parts[i : i + 2] = [whole]
            self.whole[token] = parts == [token]
        return self.whole[token]

    def _edge(self, token: int, right: bool) -> list[tuple[int, int, int]]:
        """(piece, rank that forms it, rank that ends it) along one edge of a token, from the whole to a byte."""
        held = self.edges[right]
        if token not in held:
            out, piece, until = [], token, 1 << 30
            while piece in self.parts:
                rank, x, y = self.parts[piece]
                out.append((piece, rank, until))
                piece, until = (y if right else x), rank
            out.append((piece, -1, until))
            held[token] = out
        return held[token]

    def _compatible(self, before: int, token: int) -> bool:
        key = before * self.size + token
        fits = self.fits.get(key)
        if fits is None:
            if len(self.fits) > MAX_WORDS:
                self.fits.clear()
            fits = self.fits[key] = self._never_merge(before, token)
        return fits

    def _never_merge(self, before: int, token: int) -> bool:
        rank, left = self.rank, self._edge(token, False)
        for x, x_from, x_until in self._edge(before, True):
            row = x * self.size
            for y, y_from, y_until in left:
                m = rank.get(row + y)
                # Of two equal merges the left one goes first.
                if m is not None and x_from < m[0] < x_until and y_from < m[0] <= y_until:
                    return False
        return True

    def _transition(self, word: bytes, i: int, last: list[int], emitted: list[int]) -> tuple[int, int]:
        """Last token and number of tokens of ``word[: i + 1]`` from those of its prefixes."""
        node, found, behind, ends = 0, [], self.behind, self.ends
        for j in range(i, -1, -1):
            node = behind.get(node * 256 + word[j])
            if node is None:
                break
            if node in ends:
                found.append((j, ends[node]))
        for j, token in reversed(found):
            if self._is_whole(token) and (j == 0 or self._compatible(last[j], token)):
                return token, emitted[j] + 1
        raise ValueError("a byte is no token of this vocabulary")

    def count(self, word: bytes) -> int:
        keep = len(word) <= CHUNK
        if len(self.last) > MAX_STATES:
            self.clear()
        state, last, emitted = 0, [-1], [0]
        for i, byte in enumerate(word):
            key = state * 256 + byte
            goes = self.next.get(key) if keep else None
            if goes is None:
                token, n = self._transition(word, i, last, emitted)
                if keep:
                    goes = self.next[key] = len(self.last)
                    self.last.append(token)
                    self.emitted.append(n)
            else:
                token, n = self.last[goes], self.emitted[goes]
            last.append(token)
            emitted.append(n)
            state = goes if keep else 0
        return emitted[-1]


def _byte_units() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary file (a fixed rule of the format)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class TokenCounter:
    """Counts tokens of batches of texts for one vocabulary definition (parsed JSON)."""

    def __init__(self, definition: dict):
        pre = definition["pre_tokenizer"]
        if definition["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or definition.get("normalizer"):
            raise ValueError("only plain byte-level BPE vocabularies can be compiled")
        self.words = WordMachine(definition)
        self.special = sorted((t["content"] for t in definition.get("added_tokens", [])), key=len, reverse=True)
        self.classes, (self.to, self.emit) = char_classes(), splitter()
        self.known: dict[int, int] = {}

    def count(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), dtype=np.int64)
        parts, owner = [], []
        for i, text in enumerate(texts):
            pieces = [text]
            for s in self.special:
                pieces = [x for p in pieces for x in _cut(p, s)] if s in text else pieces
            out[i] = sum(p is None for p in pieces)
            pieces = [p for p in pieces if p]
            parts += pieces
            owner += [i] * len(pieces)
        if not parts:
            return out
        text = "".join(parts)
        code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        lens = np.array([len(p) for p in parts])
        begins = np.cumsum(lens) - lens
        starts = word_starts(symbols(code, begins, self.classes), self.to, self.emit)
        size = np.diff(np.append(starts, len(code)))
        pos = np.arange(len(code)) - np.repeat(starts, size)
        hashes = mix(np.add.reduceat((code.astype(U64) + U64(1)) * powers(int(size.max()) + 1)[pos], starts))
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > MAX_WORDS:
            self.known.clear()
        counts, known = np.zeros(len(keys), dtype=np.int64), self.known
        for j, key in enumerate(keys.tolist()):
            n = known.get(key)
            if n is None:
                at = int(starts[first[j]])
                n = known[key] = self.words.count(text[at : at + int(size[first[j]])].encode())
            counts[j] = n
        row = np.array(owner)[np.searchsorted(begins, starts, side="right") - 1]
        np.add.at(out, row, counts[inverse])
        return out


def _cut(piece: str | None, special: str) -> list[str | None]:
    """Parts between occurrences of a special string, with None in place of each occurrence."""
    if piece is None:
        return [None]
    out: list[str | None] = []
    for i, p in enumerate(piece.split(special)):
        out += [None, p] if i else [p]
    return out


_COUNTERS: dict[int, TokenCounter] = {}


def _counter(definition: bytes) -> TokenCounter:
    key = hash(definition)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = TokenCounter(json.loads(definition))
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for every row of ``docs``.

    ``vocabulary`` is the path of a byte-level BPE definition (JSON) on the
    driver; its bytes (a few MB) are broadcast.  A null text is empty and has
    no tokens.  Repeated rows are counted each for itself, other columns are
    ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def scan(batches):
        counter = _counter(shared.value)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            n = [counter.count(texts.slice(i, k).to_pylist()) for i, k in text_slices(texts)]
            counts = pa.array(np.concatenate(n) if n else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.binary_length(texts).cast(pa.int64()), counts], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, "doc_id long, n_bytes long, n_tokens long")
