"""Line deduplication over levelled sorted runs of line hashes.

The store keeps, per level, runs of ``(key, owner)``: bucketed tables sorted by
the 128-bit line key.  A new batch is merge-anti-joined with every run; the
keys that no run holds become a new run, so a key lies in exactly one run.
When a level has ``fanout`` runs they are compacted into one run of the next
level.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import ship_package, store
from tessera.sinks.layout import bucket_count, write_bucketed

#: White space that is stripped from both ends of a line.
BLANKS = b" \t\n\x0b\x0c\r"
MIN_CHARS = 10


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit key of a line (stripped, A-Z lower-cased), or None if it is shorter than ``min_chars`` code points."""
    text = line.strip(BLANKS).lower()  # bytes.lower() touches A-Z only
    if len(text) < min_chars or (not text.isascii() and len(text.decode()) < min_chars):
        return None
    return hashlib.blake2b(text, digest_size=16).digest()


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, key)``: the distinct keys of every document; rows without id are left out."""

    def scan(batches):
        for batch in batches:
            ids, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = text.as_buffer()
                own = {line_key(x, min_chars) for x in (raw.to_pybytes() if raw else b"").split(b"\n")}
                own.discard(None)
                keys.extend(own)
                ids.extend([doc] * len(own))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["doc_id", "key"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    return rows.mapInArrow(scan, "doc_id long, key binary")


class LineRuns:
    """The levelled store.  ``add_batch`` takes ``(doc_id, key)`` rows, remembers new keys, returns the rows to drop.

    Runs are held as frames over stored, bucketed files; none leaves a name in
    the catalog.  The number of buckets follows the shuffle width, within what
    Spark allows.
    """

    def __init__(self, spark: SparkSession, fanout: int = 3, buckets: int | None = None):
        self.fanout, self.buckets = fanout, bucket_count(spark, buckets)
        self.levels: list[list[DataFrame]] = [[]]

    def _write_run(self, rows: DataFrame) -> DataFrame:
        return write_bucketed(rows, ["key"], buckets=self.buckets, name="line_run")

    def _put(self, run: DataFrame, level: int = 0) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._put(self._write_run(reduce(DataFrame.unionByName, runs)), level + 1)

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def add_batch(self, rows: DataFrame) -> DataFrame:
        """Rows of this batch whose line goes: its key is in an older run, or a smaller doc_id of the batch holds it."""
        fresh = rows.groupBy("key").agg(F.min("doc_id").alias("owner"))
        for run in self.runs():
            fresh = fresh.join(run.select("key"), "key", "left_anti")
        run = self._write_run(fresh)
        own = run.select("key", F.col("owner").alias("doc_id"))
        drops = store(rows.join(own, ["key", "doc_id"], "left_anti"), "line-drops")
        self._put(run)
        return drops


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    min_chars: int = MIN_CHARS,
    batches: int = 4,
    fanout: int = 3,
) -> DataFrame:
    """Every row of ``docs`` with repeated lines removed.

    Returns ``doc_id, text`` (the kept lines joined by newline), the columns
    named in ``keep``, and ``n_lines, n_dropped, emptied`` (lines before
    dropping, lines lost, whether lines went and no line with a key is left).

    The table is taken in ``batches`` ascending ranges of ids, so the smallest
    id that holds a key owns it whatever the number of batches.  A null or
    empty text is one empty line; a row without id neither owns nor loses
    lines; rows that share an id count as one document (they lose no line to
    each other); other columns are ignored unless named in ``keep`` (one that is
    named like a result is a ValueError); an empty table gives an empty result.
    """
    if taken := {"doc_id", "text", "n_lines", "n_dropped", "emptied"}.intersection(keep):
        raise ValueError(f"columns to keep are named like results: {sorted(taken)}")
    spark = docs.sparkSession
    ship_package(spark)
    keys = store(line_keys(docs, id_col, text_col, min_chars), "line-keys")
    cuts = keys.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    bounds = [None, *sorted({int(c) for c in cuts}), None]
    runs, drops = LineRuns(spark, fanout), None
    for low, high in zip(bounds, bounds[1:], strict=False):
        within = F.lit(True)
        if low is not None:
            within &= F.col("doc_id") > low
        if high is not None:
            within &= F.col("doc_id") <= high
        found = runs.add_batch(keys.where(within))
        drops = found if drops is None else drops.unionByName(found)
    lost_keys = "gone" + "_" * max(map(len, keep), default=0)  # no column to keep has this name
    by_doc = drops.groupBy("doc_id").agg(F.collect_set("key").alias(lost_keys))
    picked: list[Column] = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *(F.col(c) for c in keep)]
    rows = docs.select(*picked)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    names = rows.columns

    def cut(part):
        for batch in part:
            texts, total, lost_n, emptied = [], [], [], []
            for text, gone in zip(batch.column(1), batch.column(len(names)), strict=True):
                raw = text.as_buffer()
                lines = (raw.to_pybytes() if raw else b"").split(b"\n")
                lost, left, bare = set(gone.as_py() or ()), lines, False
                if lost:
                    own = [line_key(x, min_chars) for x in lines]
                    left = [x for x, k in zip(lines, own, strict=True) if k not in lost]
                    bare = all(k is None or k in lost for k in own)
                texts.append(b"\n".join(left).decode())
                total.append(len(lines))
                lost_n.append(len(lines) - len(left))
                emptied.append(bare)
            cols = [batch.column(0), pa.array(texts, pa.string()), *(batch.column(i) for i in range(2, len(names)))]
            cols += [pa.array(total, pa.int64()), pa.array(lost_n, pa.int64()), pa.array(emptied, pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, [*names, "n_lines", "n_dropped", "emptied"])

    joined = rows.join(by_doc, "doc_id", "left").select(*names, lost_keys)
    return joined.mapInArrow(cut, f"{schema}, n_lines long, n_dropped long, emptied boolean")
