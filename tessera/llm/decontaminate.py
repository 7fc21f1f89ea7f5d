"""Benchmark decontamination by winnowing.

Both sides keep, of every ``window`` words, the smallest hash among the
``gram``-word grams inside.  A shared run of ``window`` words therefore shares
a kept gram: the kept grams of the benchmark are looked up among those of the
documents, and every hit is extended to all windows around it, whose full
hashes are joined with the benchmark's windows.  Items shorter than a window
are one window of their own length and are looked up as such.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship_package, store, text_slices
from tessera.llm.text import ALNUM_WORDS, U64, grams, mix, text_bytes, words

WINDOW, GRAM = 10, 5
#: Kept benchmark grams that one pass over the documents carries (8 bytes each); more are taken in further passes.
GRAMS_PER_PASS = 1_000_000


def winnow(hashes: np.ndarray, row: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(gram hashes, positions kept): of every window inside one text, the place of its smallest gram."""
    g = grams(hashes, gram)
    n = len(hashes) - window + 1
    if n <= 0:
        return g, np.zeros(0, np.int64)
    span = window - gram + 1
    at = np.stack([g[j : j + n] for j in range(span)]).argmin(axis=0) + np.arange(n)
    keep = np.zeros(len(g), dtype=bool)
    keep[at[row[:n] == row[window - 1 :]]] = True
    return g, np.flatnonzero(keep)


def window_hash(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of the ``size`` words from each start."""
    out = np.full(len(starts), U64(size))
    for j in range(size):
        out = mix(out * U64(0x9E3779B97F4A7C15) + hashes[starts + j])
    return out


def _contains(sorted_set: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def _read_items(window: int, gram: int):
    """Rows (item_id, size, hash, is_gram) of the benchmark: all windows, and the kept grams."""

    def scan(batches):
        for batch in batches:
            ids = np.array(batch.column(0).to_pylist(), dtype=np.int64)
            for first, n in text_slices(batch.column(1)):
                h, row, counts = words(*text_bytes(batch.column(1).slice(first, n)), ALNUM_WORDS)
                own, begin = ids[first : first + n], np.cumsum(counts) - counts
                starts = np.flatnonzero(row[: len(h) - window + 1] == row[window - 1 :]) if len(h) >= window else np.zeros(0, np.int64)
                g, kept = winnow(h, row, window, gram)
                parts = [(own[row[starts]], window, window_hash(h, starts, window), False), (own[row[kept]], gram, g[kept], True)]
                for size in range(1, window):
                    short = np.flatnonzero(counts == size)
                    parts.append((own[short], size, window_hash(h, begin[short], size), False))
                for item, size, hashes, is_gram in parts:
                    k = len(hashes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(item), pa.array(np.full(k, size)), pa.array(hashes.view(np.int64)), pa.array(np.full(k, is_gram))],
                        ["item_id", "size", "hash", "is_gram"],
                    )

    return scan


def _find(kept, short, window: int, gram: int, with_rows: bool):
    """Rows (doc_id, mark, n_words) for every document and (doc_id, mark, start, size, hash) for windows around hits."""

    def rows(ids, marks, n_words, start, size, hashes):
        nothing = lambda kind: pa.nulls(len(ids), kind)
        return pa.RecordBatch.from_arrays(
            [ids, marks, nothing(pa.int64()) if n_words is None else pa.array(n_words)]
            + ([nothing(pa.int64())] * 3 if start is None else [pa.array(start), pa.array(size), pa.array(hashes.view(np.int64))]),
            ["doc_id", "mark", "n_words", "start", "size", "hash"],
        )

    def scan(batches):
        fps, shorts = kept.value, short.value
        for batch in batches:
            for first, n in text_slices(batch.column(2)):
                ids, marks = batch.column(0).slice(first, n), batch.column(1).slice(first, n)
                h, row, counts = words(*text_bytes(batch.column(2).slice(first, n)), ALNUM_WORDS)
                begin = np.cumsum(counts) - counts
                if with_rows:
                    yield rows(ids, marks, counts.astype(np.int64), None, None, None)
                found = []
                if len(h) >= window and len(fps):
                    g, at = winnow(h, row, window, gram)
                    at = at[_contains(fps, g[at])]
                    near = np.unique((at[:, None] - np.arange(window - gram + 1)).ravel())
                    near = near[(near >= 0) & (near <= len(h) - window)]
                    near = near[row[near] == row[near + window - 1]]
                    found.append((near, window, window_hash(h, near, window)))
                for size, wanted in shorts.items():
                    if len(h) >= size:
                        at = np.flatnonzero(row[: len(h) - size + 1] == row[size - 1 :])
                        hashes = window_hash(h, at, size)
                        hit = _contains(wanted, hashes)
                        found.append((at[hit], size, hashes[hit]))
                for at, size, hashes in found:
                    if len(at):
                        pick = pa.array(row[at])
                        yield rows(ids.take(pick), marks.take(pick), None, at - begin[row[at]], np.full(len(at), size), hashes)

    return scan


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    grams_per_pass: int = GRAMS_PER_PASS,
) -> DataFrame:
    """``doc_id, mark, n_words, n_hit, items, contaminated`` for every row of ``docs``.

    ``mark`` is a hash of the text, so that rows sharing an id (or having none)
    are told apart; ``n_hit`` counts words inside an occurrence of a benchmark
    window, ``items`` lists the item ids (as sorted strings) that have an
    occurring window.  Null and empty texts have no words; items without id or
    without words match nothing; repeated items and rows change nothing.  Short
    items are kept per length in memory on the same terms as grams.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bench = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).where("item_id is not null")
    parts = store(bench.mapInArrow(_read_items(window, gram), "item_id long, size long, hash long, is_gram boolean").distinct(), "benchmark")
    wins = parts.where("not is_gram").select("item_id", "size", "hash")

    # Every distinct look-up key, in passes of a bounded number of keys.
    keys = parts.where(F.col("is_gram") | (F.col("size") < window)).select("size", "hash", "is_gram").distinct()
    n_keys = keys.count()
    passes = max(1, -(-n_keys // grams_per_pass))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("mark"), F.col(text_col).alias("text"))
    schema = "doc_id long, mark long, n_words long, start long, size long, hash long"
    seen = None
    for k in range(passes):
        part = keys.where(F.pmod(F.xxhash64("hash"), F.lit(passes)) == k).collect()
        kept = np.sort(np.array([r["hash"] for r in part if r["is_gram"]], dtype=np.int64).view(U64))
        sizes = {r["size"] for r in part if not r["is_gram"]}
        short = {s: np.sort(np.array([r["hash"] for r in part if not r["is_gram"] and r["size"] == s], dtype=np.int64).view(U64)) for s in sizes}
        cast = spark.sparkContext.broadcast
        found = rows.mapInArrow(_find(cast(kept), cast(short), window, gram, k == 0), schema)
        seen = found if seen is None else seen.unionByName(found)
    seen = store(seen, "windows")

    at = ["doc_id", "mark"]
    hits = store(seen.where("start is not null").distinct().join(wins.select("size", "hash").distinct(), ["size", "hash"], "left_semi"), "hits")
    spans = hits.groupBy(*at).agg(F.array_sort(F.collect_set(F.struct("start", "size"))).alias("spans"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["upto"], s["start"] + s["size"]).alias("upto"),
            (acc["n"] + F.greatest(F.lit(0).cast("long"), s["start"] + s["size"] - F.greatest(acc["upto"], s["start"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    named = hits.select(*at, "size", "hash").distinct().join(wins, ["size", "hash"]).select(*at, F.col("item_id").cast("string").alias("item")).distinct()
    named = named.groupBy(*at).agg(F.array_sort(F.collect_list("item")).alias("items"))
    found = spans.select(*at, covered.alias("n_hit")).alias("s").join(named.alias("i"), F.expr("s.doc_id <=> i.doc_id and s.mark = i.mark"))
    found = found.select("s.doc_id", "s.mark", "n_hit", "items").alias("f")
    base = seen.where("n_words is not null").select(*at, "n_words").alias("b")
    out = base.join(found, F.expr("b.doc_id <=> f.doc_id and b.mark = f.mark"), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("b.doc_id", "b.mark", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` (all their columns) without an occurrence of a benchmark window."""
    bad = find_contamination(docs, items, id_col, text_col, **options).where("contaminated")
    # Stored, so that its size is known and the texts are not shuffled for a short list.
    bad = store(bad.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")), "contaminated")
    return docs.join(bad, (F.col(id_col).cast("long").eqNullSafe(F.col("__id"))) & (F.xxhash64(F.col(text_col)) == F.col("__mark")), "left_anti")
