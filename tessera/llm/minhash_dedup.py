"""Near-duplicate documents: MinHash bands propose, odd sketches estimate, full shingle sets confirm.

1. One pass over the texts gives every document its shingle set's key, 128
   MinHash samples folded into 24 bands of 4, and the odd sketch: a bitmap in
   which every sample flips one bit, so that the XOR of two sketches has few
   ones exactly if the sets are very similar.
2. Documents with equal sets are one class; from here on a node is a class.
3. In every band bucket all members are compared with one hub (a pair per
   member, never all pairs).  The odd sketch drops hopeless pairs, the rest is
   confirmed on the full sets, and connected components are formed.
4. Buckets whose members are still in different components are compared part
   by part, never the members of the largest component with each other; inside
   a task only pairs of different components are looked at, each in the first
   band that both share, and only a spanning forest of the confirmed links
   leaves the task.

So no candidate pair is skipped unless its ends are connected already.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship_package, store, text_slices
from tessera.llm.graph import connected_components
from tessera.llm.text import BLANK_WORDS, U64, mix, text_bytes, words

BANDS, ROWS, SAMPLES, SKETCH_BITS = 24, 4, 128, 512
BLOCK = 512  # members of a bucket that one task compares with as many others

_rng = np.random.default_rng(20240229)
_MUL = (_rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64) | U64(1)).astype(np.uint32)[:, None]
_ADD = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)[:, None]
_SALT = _rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)


def shingle_sets(column: pa.Array, size: int):
    """Sorted distinct 64-bit shingle hashes of every text of an Arrow column (an empty array without words)."""
    for first, n in text_slices(column):
        hashes, _, counts = words(*text_bytes(column.slice(first, n)), BLANK_WORDS)
        joined = hashes.copy()
        for j in range(1, size):
            joined[:-j] = joined[:-j] * U64(0xD6E8FEB86659FD93) + hashes[j:]
        joined = mix(joined)
        at = 0
        for c in counts.tolist():
            if c >= size:
                yield np.unique(joined[at : at + c - size + 1])
            elif c:
                whole = U64(c)
                for x in hashes[at : at + c]:
                    whole = U64((int(whole) * 0xD6E8FEB86659FD93 + int(x)) & 0xFFFFFFFFFFFFFFFF)
                yield mix(np.array([whole], U64))
            else:
                yield hashes[:0]
            at += c


def set_node(shingles: np.ndarray) -> int:
    """Signed 64-bit key of a shingle set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """``SAMPLES`` MinHash values of a set, computed in blocks so that very long texts need no more memory."""
    low = (shingles >> U64(32)).astype(np.uint32)
    best = np.full(SAMPLES, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(low), 1024):
        np.minimum(best, (low[None, i : i + 1024] * _MUL + _ADD).min(axis=1), out=best)
    return best


def bands(samples: np.ndarray) -> np.ndarray:
    """One 64-bit value per band."""
    s = samples[: BANDS * ROWS].astype(U64).reshape(BANDS, ROWS)
    out = np.arange(BANDS, dtype=U64)
    for j in range(ROWS):
        out = mix(out * U64(0x9E3779B97F4A7C15) + s[:, j])
    return out.view(np.int64)


def odd_sketch(samples: np.ndarray) -> bytes:
    """Parity bitmap of the samples."""
    at = mix(samples.astype(U64) ^ _SALT) % U64(SKETCH_BITS)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=SKETCH_BITS).astype(np.uint8) & 1).tobytes()


def estimate(ones: np.ndarray) -> np.ndarray:
    """Similarity estimated from the number of ones in the XOR of two odd sketches."""
    share = np.minimum(2.0 * np.asarray(ones, dtype=float) / SKETCH_BITS, 0.999999)
    return 1.0 + SKETCH_BITS / (4.0 * SAMPLES) * np.log1p(-share)


def is_link(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted distinct arrays."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sketch(size: int):
    def scan(batches):
        for batch in batches:
            n, node, band, odd, sets = [], [], [], [], batch.column(1)
            for s in shingle_sets(sets, size):
                n.append(len(s))
                if len(s):
                    samples = minhash(s)
                    node.append(set_node(s))
                    band.append(bands(samples))
                    odd.append(odd_sketch(samples))
                else:
                    node.append(None)
                    band.append(None)
                    odd.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(band, pa.list_(pa.int64())), pa.array(odd, pa.binary()), *batch.columns[2:]],
                ["doc_id", "n_shingles", "node", "bands", "odd", *batch.schema.names[2:]],
            )

    return scan


def _sets(size: int):
    def scan(batches):
        for batch in batches:
            node, data, band, odd = [], [], [], []
            for want, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), size), strict=True):
                if len(s) and set_node(s) == want:  # rows that share an id may have other texts
                    samples = minhash(s)
                    node.append(want)
                    data.append(s.tobytes())
                    band.append(bands(samples))
                    odd.append(odd_sketch(samples))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.int64()), pa.array(data, pa.binary()), pa.array(band, pa.list_(pa.int64())), pa.array(odd, pa.binary())],
                ["node", "shingles", "bands", "odd"],
            )

    return scan


def _confirm(percent: int, least: float):
    """Pairs whose odd sketches are close enough, confirmed on the full sets."""

    def scan(batches):
        for batch in batches:
            sa, sb, oa, ob = (batch.column(i).to_pylist() for i in range(2, 6))
            ones = [int(np.bitwise_count(np.frombuffer(x, U64) ^ np.frombuffer(y, U64)).sum()) for x, y in zip(oa, ob, strict=True)]
            near = estimate(np.array(ones)) >= least
            ok = [bool(k) and is_link(np.frombuffer(x, U64), np.frombuffer(y, U64), percent) for k, x, y in zip(near, sa, sb, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return scan


class _Forest:
    """Union-find over the components that one task sees."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x, y) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _finish(percent: int, least: float):
    """Pairs of components that are linked, from one group of :func:`_layout`."""

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node").drop_duplicates("node").reset_index(drop=True)
        comp, own = part["comp"].to_numpy(), part["own"].to_numpy()
        band = np.stack(part["bands"].to_list()).astype(np.int64)
        odd = np.frombuffer(b"".join(bytes(x) for x in part["odd"]), np.uint64).reshape(len(part), -1)
        sets = [np.frombuffer(bytes(x), U64) for x in part["shingles"]]
        top = part["top"].to_numpy()
        here, kind, lo, hi = (int(part[c].iloc[0]) for c in ("bucket", "kind", "lo", "hi"))
        forest, found = _Forest(), []
        for i in range(len(part)):
            wanted = comp[i + 1 :] != comp[i]
            if kind == TOP_OTHER:
                wanted &= top[i + 1 :] != top[i]
            elif kind == OTHER_OTHER and lo != hi:
                wanted &= own[i + 1 :] != own[i]
            j = np.flatnonzero(wanted) + i + 1
            if not len(j):
                continue
            j = j[estimate(np.bitwise_count(odd[j] ^ odd[i]).sum(axis=1)) >= least]
            shared = band[j] == band[i]
            j = j[band[i][shared.argmax(axis=1)] == here] if len(j) else j  # each pair once: in the first band it shares
            for k in j.tolist():
                if forest.root(comp[i]) != forest.root(comp[k]) and is_link(sets[i], sets[k], percent):
                    forest.join(comp[i], comp[k])
                    found.append((comp[i], comp[k]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return compare


#: Groups of members that are compared in one task: a whole bucket, parts of its largest component and of the others, two parts of the others.
WHOLE, TOP_OTHER, OTHER_OTHER = 0, 1, 2


def _layout(placed: DataFrame, block: int) -> DataFrame:
    """Members of buckets that hold several components, once per group in which they are compared.

    ``placed (bucket, node, comp)``.  A bucket of at most ``block`` members is
    one group.  In a larger one, members of the largest component are never
    compared with each other: parts of it meet parts of the others, and parts
    of the others meet each other, so a hot bucket that is settled but for a
    few members is sent about once.
    """
    sizes = placed.groupBy("bucket", "comp").agg(F.count("*").alias("m")).groupBy("bucket")
    sizes = sizes.agg(F.sum("m").alias("all"), F.max("m").alias("most"), F.max_by("comp", F.struct("m", "comp")).alias("top_comp"), F.count("*").alias("comps"))
    parts = lambda n: F.greatest(F.ceil(n / block), F.lit(1)).cast("int")
    sizes = sizes.where("comps > 1").select("bucket", "all", "top_comp", parts(F.col("most")).alias("n_top"), parts(F.col("all") - F.col("most")).alias("n_other"))
    rows = placed.join(sizes, "bucket").withColumn("top", F.col("comp") == F.col("top_comp"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("top"), F.col("n_top")).otherwise(F.col("n_other"))).cast("int")
    rows = rows.withColumn("own", own)
    group = lambda kind, lo, hi: F.struct(F.lit(kind).alias("kind"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    met = F.transform(upto("n_other"), lambda j: group(TOP_OTHER, F.col("own"), j))
    meets = F.transform(upto("n_top"), lambda k: group(TOP_OTHER, k, F.col("own")))
    others = F.transform(upto("n_other"), lambda j: group(OTHER_OTHER, F.least("own", j), F.greatest("own", j)))
    groups = F.when(F.col("all") <= block, F.array(group(WHOLE, F.lit(0), F.lit(0)))).when(F.col("top"), met).otherwise(F.concat(meets, others))
    return rows.select("bucket", "node", "comp", "top", "own", F.explode(groups).alias("g")).select("bucket", "node", "comp", "top", "own", "g.*")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80, margin: float = 0.25, block: int = BLOCK, mark: bool = False
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (with ``mark``: its text's xxhash64 too).

    Texts are linked if 100 * intersection >= ``percent`` * union of their sets
    of distinct ``shingle_words``-word shingles (a shorter text is one shingle
    as a whole).  component_id is the smallest doc_id reachable over links.  A
    pair is not confirmed if its estimated similarity lies more than
    ``margin`` (over five standard deviations) below the threshold.

    A text that is null, empty or without words has no shingles and is a
    component of its own.  A row without id has a null component_id and is
    kept.  Rows that share an id and a text share a component; rows that share
    only the id are nodes of their own.  Other columns are ignored, an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marked = rows.withColumn("mark", F.xxhash64("text")) if mark else rows
    schema = "doc_id long, n_shingles long, node long, bands array<bigint>, odd binary" + ", mark long" * mark
    sketches = store(marked.mapInArrow(_sketch(shingle_words), schema), "sketches")
    classes = store(sketches.where("node is not null and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("first_id")), "classes")
    # One row per class: the row of its smallest id (repeated rows may give several equal ones).
    one = sketches.join(classes.withColumnRenamed("first_id", "doc_id"), ["node", "doc_id"]).select("node", "doc_id", "bands", "odd")
    members = one.select("node", "doc_id", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub < top").drop("top")
    members = store(members.join(buckets, "bucket").distinct(), "members")

    ids = members.select("node", "doc_id").distinct()
    texts = rows.join(ids, "doc_id").select("node", "text")
    sets = texts.mapInArrow(_sets(shingle_words), "node long, shingles binary, bands array<bigint>, odd binary")
    sets = store(sets.dropDuplicates(["node"]), "sets")

    least = percent / 100 - margin
    pairs = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"), F.col("odd").alias("oa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"), F.col("odd").alias("ob"))
    pairs = pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb", "oa", "ob")
    first = store(pairs.mapInArrow(_confirm(percent, least), "a long, b long"), "star-links")

    roots = connected_components(first)
    placed = members.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("comp"))
    placed = store(_layout(placed, block), "unsettled")
    second = placed.join(sets, "node").groupBy("bucket", "kind", "lo", "hi").applyInPandas(_finish(percent, least), "a long, b long")
    # The components of the first links, joined by the second ones.
    joined = connected_components(store(second, "links")).select(F.col("node").alias("root"), F.col("root").alias("final"))
    rooted = classes.join(roots, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    rooted = rooted.join(joined, "root", "left").select("node", "first_id", F.coalesce("final", "root").alias("root"))
    rooted = store(rooted, "roots")
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    rooted = rooted.join(smallest, "root").select("node", "component_id")
    out = sketches.select("doc_id", "n_shingles", "node", *["mark"] * mark).join(rooted, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"), *["mark"] * mark)
