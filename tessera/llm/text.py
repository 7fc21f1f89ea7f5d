"""Vectorised word scanning over the UTF-8 bytes of a batch of texts (numpy)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_POW_BASE = U64(0x9E3779B97F4A7C15)
_pow = np.ones(1, dtype=U64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words end at space, tab, newline, vertical tab, form feed, carriage return.
BLANK_WORDS = np.ones(256, dtype=bool)
BLANK_WORDS[[0x20, *range(0x09, 0x0E)]] = False

#: Words of digits, letters and non-ASCII code points (after lower-casing A-Z).
ALNUM_WORDS = np.zeros(256, dtype=bool)
ALNUM_WORDS[0x30:0x3A] = ALNUM_WORDS[0x61:0x7B] = True
ALNUM_WORDS[0x80:] = True


def powers(n: int) -> np.ndarray:
    """Powers of the hash base, at least ``n`` of them."""
    global _pow
    if len(_pow) < n:
        out = np.full(max(n, 256), _POW_BASE, dtype=U64)
        out[0] = 1
        _pow = np.multiply.accumulate(out)
    return _pow


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising bijection on 64-bit values (splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the n + 1 offsets; null is the empty text."""
    col = column.fill_null("") if column.null_count else column
    col = col.cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash of every lower-cased word, the words' row numbers, and word counts per row.

    ``word_bytes`` says which bytes (after lower-casing) belong to words; a
    word never crosses the border of two texts.
    """
    n_rows = len(offsets) - 1
    low = LOWER[data]
    inside = word_bytes[low]
    if not inside.any():
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(n_rows, np.int64)
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    borders = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[borders] = inside[borders]
    at = np.flatnonzero(starts)
    rank = np.cumsum(inside) - 1  # index of each word byte among the word bytes
    first = rank[at]
    chars = low[inside].astype(U64)
    lens = np.diff(np.append(first, len(chars)))
    pos = np.arange(len(chars)) - np.repeat(first, lens)
    hashes = mix(np.add.reduceat((chars + U64(1)) * powers(int(lens.max()) + 1)[pos], first))
    row = np.searchsorted(offsets[1:], at, side="right")
    return hashes, row, np.bincount(row, minlength=n_rows)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` neighbouring words (row borders are not looked at)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    out = np.zeros(m, dtype=U64)
    for j in range(n):
        out = out * U64(0xD6E8FEB86659FD93) + hashes[j : j + m]
    return mix(out)
