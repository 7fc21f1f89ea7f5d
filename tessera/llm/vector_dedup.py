"""Near-duplicate vectors by a subspace pigeonhole join.

For unit vectors, cosine >= t means a squared distance of at most 2 - 2t.  The
vectors are rotated at random and cut into blocks of equal width; two vectors
within the distance are within a block's proportional share of it in at least
one block.  Each block is range-joined: a vector lives in the cell given by on
which side of the mean its leading coordinates lie, and is repeated in the
lower cells that its range reaches, so a pair meets in the cell of the sides
both have in common.  The more vectors, the more coordinates make up a cell.
Inside a cell, halves along the widest coordinate are compared with themselves
and, as far as their ranges reach each other, with one another, down to leaves
that are multiplied; pairs within the block's budget are confirmed on the whole
vectors in double precision.

A pair is counted once: in the first block whose budget it keeps, in the cell
of its common sides.  Tasks return counts and a spanning forest, never the
pairs, so a large group of near copies costs comparisons but no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tessera.llm.common import ship_package, store
from tessera.llm.graph import connected_components

BLOCK_DIMS = 16
#: Coordinates that make up a cell, at least, and the rows of a cell from which on there are more.
CELL_DIMS, CELL_ROWS = 4, 4096
#: Rows of a cell that one task compares with as many others; larger cells are cut into pairs of parts.
PART_ROWS = 32_768
#: Rows of a leaf, rows of a product at most, pairs confirmed in one step.
LEAF, TILE, PAIRS = 256, 1024, 200_000
SLACK = 1e-9


def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(977 + dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def block_ranges(dims: int, width: int = BLOCK_DIMS) -> list[tuple[int, int]]:
    return [(a, min(a + width, dims)) for a in range(0, dims, width)]


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cell_bits(vectors: int, cell_rows: int = CELL_ROWS) -> int:
    """Leading coordinates that make up a cell: about ``cell_rows`` vectors live in one."""
    return max(CELL_DIMS, int(np.ceil(np.log2(max(vectors, 1) / cell_rows))))


def reached_cells(lead: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Home cell of every row, and (row, cell) of all cells that rows must be in.

    A row goes to its home cell and to those below it that lie within the squared distance ``limit``: two rows
    that near lie on different sides only of coordinates whose upper side is that near to the middle.
    """
    upper, square = lead >= 0, lead * lead
    home = (upper * (1 << np.arange(lead.shape[1]))).sum(axis=1)
    row, cell, spent = np.arange(len(lead)), home.copy(), np.zeros(len(lead))
    for c in range(lead.shape[1]):
        more = np.flatnonzero(upper[row, c] & (spent + square[row, c] <= limit))
        row, cell, spent = (
            np.concatenate([row, row[more]]), np.concatenate([cell, cell[more] ^ (1 << c)]), np.concatenate([spent, spent[more] + square[row[more], c]]),
        )
    return home, row, cell


def _cells(mean: dict[int, np.ndarray], bits: dict[int, int], budget: float, kind, whole: bool):
    """Rows (dims, block, cell) for every cell of a vector, and (node, home, copies, vec) if ``whole``."""

    def scan(batches):
        for batch in batches:
            node, copies, vec = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            sizes = np.array([len(v) for v in vec.to_pylist()]) if len(vec) else np.zeros(0, int)
            for dims in np.unique(sizes):
                own = np.flatnonzero(sizes == dims)
                raw = np.array(vec.take(pa.array(own)).to_pylist(), dtype=np.float64)
                turn = rotation(int(dims))
                y = (unit(raw) - mean[int(dims)]) @ turn
                data = [r.tobytes() for r in raw.astype(kind)] if whole else []
                for b, (lo, hi) in enumerate(block_ranges(int(dims))):
                    lead = y[:, lo : lo + min(bits[int(dims)], hi - lo)]
                    home, row, cell = reached_cells(lead, budget * (hi - lo) / dims + 2 * SLACK)
                    n = len(row)
                    columns = [pa.array(np.full(n, dims, np.int64)), pa.array(np.full(n, b, np.int64)), pa.array(cell.astype(np.int64))]
                    if whole:
                        columns += [pa.array(node[own][row]), pa.array(home[row].astype(np.int64)), pa.array(copies[own][row]), pa.array([data[i] for i in row], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["dims", "block", "cell", "node", "home", "copies", "vec"][: len(columns)])

    return scan


def meeting_sets(home: np.ndarray, cell: int, first: np.ndarray, second: np.ndarray | None = None, leaf: int = LEAF):
    """Pairs of row sets (the second None: with itself) that hold all pairs of rows whose common sides are ``cell``.

    Rows on the upper side of a coordinate that is lower in the cell meet each other in another cell, so they are
    not paired here, but for sets too small to be cut.
    """
    work = [(first, second, [c for c in range(int(home.max()).bit_length()) if not cell >> c & 1])]
    while work:
        a, b, lower = work.pop()
        if not len(a) or (b is not None and not len(b)):
            continue
        if not lower or len(a) * len(a if b is None else b) <= leaf * leaf:
            yield a, b
            continue
        up = (home[a] >> lower[0] & 1).astype(bool)
        if b is None:
            work += [(a[~up], None, lower[1:]), (a[~up], a[up], lower[1:])]
        else:
            high = (home[b] >> lower[0] & 1).astype(bool)
            work += [(a[~up], b[~high], lower[1:]), (a[~up], b[high], lower[1:]), (a[up], b[~high], lower[1:])]


def _halves(y: np.ndarray, rows: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
    """Two non-empty halves of ``rows`` along coordinate ``at``, whose values are not all equal."""
    values = y[rows, at]
    below = values < np.median(values)
    if not below.any():
        below = values <= np.median(values)
    return rows[below], rows[~below]


def near_blocks(y: np.ndarray, limit: float, first: np.ndarray, second: np.ndarray | None = None, leaf: int = LEAF):
    """Pairs of row sets of ``y`` (the second None: with itself) that hold all pairs of rows within the squared distance.

    Every pair of rows of ``first`` and ``second`` (of ``first``, if there is no second) lies in at most one of them.
    """
    work = [(first, second)]
    while work:
        a, b = work.pop()
        if b is None:
            if len(a) <= leaf:
                yield a, None
                continue
            rows = y[a]
            low, high = rows.min(axis=0), rows.max(axis=0)
            if ((high - low) ** 2).sum() <= limit:  # nothing in it is out of reach
                for s in range(0, len(a), TILE):
                    yield a[s : s + TILE], None
                    work.append((a[s : s + TILE], a[s + TILE :]))
                continue
            left, right = _halves(y, a, (high - low).argmax())
            work += [(left, None), (right, None), (left, right)]
            continue
        for _ in range(2):  # rows out of reach of the other set's box
            if len(a) and len(b):
                gap = np.maximum(np.maximum(y[b].min(axis=0) - y[a], y[a] - y[b].max(axis=0)), 0)
                a, b = b, a[(gap * gap).sum(axis=1) <= limit]
        if not len(a) or not len(b):
            continue
        if len(a) * len(b) <= leaf * leaf:
            yield a, b
            continue
        (low, high), (least, most) = ((y[x].min(axis=0), y[x].max(axis=0)) for x in (a, b))
        widest = max((high - low).max(), (most - least).max())
        if widest == 0 or ((np.maximum(high, most) - np.minimum(low, least)) ** 2).sum() <= limit:
            for s in range(0, len(a), TILE):
                for t in range(0, len(b), TILE):
                    yield a[s : s + TILE], b[t : t + TILE]
            continue
        if (high - low).max() < (most - least).max():  # the wider set is cut
            a, b, low, high = b, a, least, most
        work += [(half, b) for half in _halves(y, a, (high - low).argmax())]


def _compare(threshold: float, budget: float, kind):
    """Counts of links and a spanning forest of one pair of parts of a cell."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        dims, block, cell = int(part["dims"].iloc[0]), int(part["block"].iloc[0]), int(part["cell"].iloc[0])
        first, second = int(part["lo"].iloc[0]), int(part["hi"].iloc[0])
        part = part.sort_values("node").reset_index(drop=True)
        node, copies, own, home = (part[c].to_numpy() for c in ("node", "copies", "own", "home"))
        u = unit(np.frombuffer(b"".join(bytes(v) for v in part["vec"]), kind).reshape(-1, dims).astype(np.float64))
        part = part.drop(columns="vec")
        turn, ranges = rotation(dims), block_ranges(dims)
        limits = np.array([budget * (b - a) / dims + SLACK for a, b in ranges])
        lo, hi = ranges[block]
        y = (u @ turn[:, lo:hi]).astype(np.float32)
        norm = (y * y).sum(axis=1)
        links, label = np.zeros(len(node), np.int64), np.arange(len(node))

        def confirm(i, j):
            diff = u[i] - u[j]
            good = 1.0 - 0.5 * (diff * diff).sum(axis=1) >= threshold - 1e-6
            i, j, diff = i[good], j[good], diff[good]
            good = (u[i] * u[j]).sum(axis=1) >= threshold
            i, j, diff = i[good], j[good], diff[good]
            moved = np.einsum("pd,de->pe", diff, turn)
            share = np.stack([(moved[:, a:b] ** 2).sum(axis=1) for a, b in ranges], axis=1) <= limits
            good = share.argmax(axis=1) == block
            i, j = i[good & share.any(axis=1)], j[good & share.any(axis=1)]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            while len(i):
                a, b = label[i], label[j]
                apart = a != b
                if not apart.any():
                    break
                i, j, a, b = i[apart], j[apart], a[apart], b[apart]
                np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
                while (label[label] != label).any():
                    label[:] = label[label]

        limit = limits[block] + 1e-5
        everyone = np.arange(len(node))
        sides = (everyone, None) if first == second else (everyone[own == first], everyone[own == second])
        held, waiting = [], 0
        for a, b in (x for sets in meeting_sets(home, cell, *sides) for x in near_blocks(y, limit, *sets)):
            c = a if b is None else b
            near = norm[a][:, None] + norm[c][None, :] - 2.0 * (y[a] @ y[c].T) <= limit
            i, j = np.nonzero(np.triu(near, 1) if b is None else near)
            i, j = a[i], c[j]
            meet = (home[i] & home[j]) == cell
            held.append((i[meet], j[meet]))
            waiting += int(meet.sum())
            if waiting >= PAIRS:
                for k in range(0, waiting, PAIRS):
                    confirm(*(np.concatenate(x)[k : k + PAIRS] for x in zip(*held)))
                held, waiting = [], 0
        if waiting:
            confirm(*(np.concatenate(x) for x in zip(*held)))
        hit = np.flatnonzero(links)
        return pd.DataFrame({"node": node[hit], "links": links[hit], "root": node[label[hit]]})

    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95, part_rows: int = PART_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Rows are linked if the cosine of their vectors (double precision) is at
    least ``threshold`` (above 0).  A vector that is null, empty, zero or holds
    a null or non-finite component links with nothing, and so does a row
    without id (its component is null, it is kept).  Vectors of different
    lengths are not compared.  Equal vectors are one node; each of its rows
    counts the others.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    vec = F.transform(F.col(vec_col).cast("array<double>"), lambda x: x + F.lit(0.0))  # -0.0 becomes 0.0
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    valid = F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", finite) & F.exists("vec", lambda x: x != 0)
    rows = rows.select("vec_id", F.when(F.coalesce(valid, F.lit(False)), F.col("vec")).alias("vec"))
    classes = rows.where("vec is not null").groupBy("vec").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    classes = store(classes.select(F.xxhash64("vec").alias("node"), "first_id", "copies", "vec"), "vectors")

    length = F.sqrt(F.aggregate(F.transform("vec", lambda x: x * x), F.lit(0.0), lambda a, x: a + x))
    parts = classes.select(F.size("vec").alias("dims"), length.alias("length"), F.posexplode("vec").alias("at", "x")).where("length > 0 and isnotnull(x)")
    counts = {r["dims"]: r["n"] for r in classes.groupBy(F.size("vec").alias("dims")).agg(F.count("*").alias("n")).collect()}  # one row per length
    bits = {dims: cell_bits(n, cell_rows) for dims, n in counts.items()}
    mean: dict[int, np.ndarray] = {dims: np.zeros(dims) for dims in counts}
    for r in parts.groupBy("dims", "at").agg(F.avg(F.col("x") / F.col("length")).alias("m")).collect():  # one row per dimension
        mean[r["dims"]][r["at"]] = r["m"] if np.isfinite(r["m"]) else 0.0

    budget = 2.0 - 2.0 * threshold
    kind = np.float32 if isinstance(vectors.select(vec_col).schema[0].dataType.elementType, FloatType) else np.float64
    key = ["dims", "block", "cell"]
    keyed = ", ".join(f"{c} long" for c in key)
    source = classes.select("node", "copies", "vec")
    cells = source.mapInArrow(_cells(mean, bits, budget, kind, True), f"{keyed}, node long, home long, copies long, vec binary")
    sizes = source.mapInArrow(_cells(mean, bits, budget, kind, False), keyed).groupBy(*key).agg(F.count("*").alias("m"))
    sizes = store(sizes.select(*key, F.ceil(F.col("m") / part_rows).cast("int").alias("parts")), "vector-cells")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    placed = cells.join(sizes, key).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = placed.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("other", "parts")
    found = store(placed.groupBy(*key, "lo", "hi").applyInPandas(_compare(threshold, budget, kind), "node long, links long, root long"), "vector-links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found, "node", "root")
    known = classes.select("node", "first_id", "copies").join(links, "node", "left").join(roots, "node", "left")
    known = store(known.select("node", "first_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root")), "vector-classes")
    smallest = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = known.join(smallest, "root").select("node", "n_links", "component_id")
    out = rows.select("vec_id", F.when(F.col("vec").isNotNull(), F.xxhash64("vec")).alias("node")).join(known, "node", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    kept = F.coalesce(component == F.col("vec_id"), F.lit(True))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), kept.alias("kept"))
