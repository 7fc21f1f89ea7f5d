import numpy as np
import pytest

from tessera.llm import queries
from tessera.llm.vector_dedup import cell_bits, meeting_sets, near_blocks, near_vectors, reached_cells
from tests.conftest import SF_ORACLE
from tests.llm.helpers import Forest, with_clashes

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.95):
    ok = [i for i, (d, v, *_) in enumerate(rows) if d is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)]
    forest, links = Forest(range(len(rows))), [0] * len(rows)
    for n, i in enumerate(ok):
        for j in ok[:n]:
            a, b = (np.array(rows[k][1], dtype=np.float32).astype(np.float64) for k in (i, j))
            if len(a) == len(b):
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    forest.join(i, j)
    low = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            low[forest.root(i)] = min(d, low.get(forest.root(i), d))
    return sorted(((d, links[i], low[forest.root(i)] if d is not None else None, d is None or low[forest.root(i)] == d) for i, (d, *_) in enumerate(rows)), key=str)


def found(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def families(dims, n=160, seed=2):
    rng = np.random.default_rng(seed)
    rows, centre = [], None
    for i in range(n):
        if i % 12 == 0:
            centre = rng.standard_normal(dims) + 0.5  # off the origin
        v = centre + rng.standard_normal(dims) * rng.choice([0.0, 0.15, 0.25, 0.32])
        rows.append((i, [float(x) for x in v * rng.choice([1.0, 3.0])], 0))
    return rows


@pytest.mark.parametrize("dims,part_rows,cell_rows", [(64, 32768, 4096), (64, 20, 4096), (64, 20, 2), (64, 32768, 0.2), (20, 32768, 1), (3, 32768, 4096)])
def test_matches_brute_force(spark, dims, part_rows, cell_rows):
    rows = families(dims)
    df = near_vectors(with_clashes(spark.createDataFrame(rows, VECTORS)), part_rows=part_rows, cell_rows=cell_rows)
    assert found(df) == brute(rows)
    assert any(r.n_links for r in df.collect())


def test_doubles_are_not_shortened(spark):
    rows = [(1, [1.0, 1e-9], 0), (2, [1.0, 1e-9 + 1e-17], 0), (3, [1e200, 1.0], 0), (4, [-1e200, 1e200], 0)]
    df = near_vectors(spark.createDataFrame(rows, VECTORS.replace("float", "double")), threshold=0.9)
    assert found(df) == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True)]


@pytest.mark.parametrize("case", ["spread", "ties", "same", "lattice"])
@pytest.mark.parametrize("split", [False, True])
def test_every_near_pair_meets_once(case, split):
    """Cells, sets of common sides and leaves against plain loops: no near pair is missed, none is met twice."""
    rng = np.random.default_rng(5)
    y = {
        "spread": lambda: rng.standard_normal((300, 5)),
        "ties": lambda: np.repeat(rng.standard_normal((60, 5)), 5, axis=0),
        "same": lambda: np.zeros((120, 5)),
        "lattice": lambda: rng.integers(-1, 2, (300, 5)).astype(float),
    }[case]()
    limit = 1.0
    home, row, cell = reached_cells(y[:, :4], limit)
    met = {}
    for c in np.unique(cell):
        rows = row[cell == c]
        assert len(np.unique(rows)) == len(rows)
        sides = (rows[rows % 2 == 0], rows[rows % 2 == 1]) if split else (rows, None)
        for a, b in (x for sets in meeting_sets(home, int(c), *sides, leaf=4) for x in near_blocks(y, limit, *sets, leaf=4)):
            pairs = ((i, j) for n, i in enumerate(a) for j in (a[:n] if b is None else b))
            for i, j in pairs:
                if home[i] & home[j] == c:
                    key = (min(i, j), max(i, j))
                    met[key] = met.get(key, 0) + 1
    near = {(i, j) for j in range(len(y)) for i in range(j) if ((y[i] - y[j]) ** 2).sum() <= limit and not (split and (i - j) % 2 == 0)}
    assert near and near <= set(met) and set(met.values()) == {1}


def test_large_groups_of_near_copies_are_tiled():
    y = np.random.default_rng(1).standard_normal((3000, 4)) * 1e-3
    sets = list(near_blocks(y, 1.0, np.arange(3000), leaf=16))
    assert max(len(a) for a, _ in sets) <= 1024
    assert sum(len(a) * (len(a) - 1) // 2 if b is None else len(a) * len(b) for a, b in sets) == 3000 * 2999 // 2


def test_cells_grow_with_the_vectors():
    assert cell_bits(0) == cell_bits(2000) == cell_bits(65_536) == 4
    assert cell_bits(65_537) == 5 and cell_bits(1 << 28) == 16


def test_odd_vectors(spark):
    v = [0.5, 0.25, -1.0]
    rows = [
        (1, None, 0), (2, [], 0), (3, [0.0, 0.0, 0.0], 0), (4, [1.0, None, 2.0], 0), (5, [float("nan"), 1.0, 1.0], 0), (6, [float("inf"), 1.0, 1.0], 0),
        (7, v, 0), (8, v, 1), (8, v, 1), (9, [2 * x for x in v], 0), (None, v, 0), (10, [1.0, 1.0], 0), (11, [1.0, 1.01], 0), (12, [0.0, 1.0], 0), (13, [-0.0, 1.0], 0),
        (14, [1e-30, 1e-30, 0.0], 0), (15, [1.0, 1.0, 0.0], 0),
    ]
    assert found(near_vectors(spark.createDataFrame(rows, VECTORS))) == brute(rows)


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], VECTORS)).collect() == []


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert found(queries.queries()["op3_embedding_near_dedup"](spark, SF_ORACLE)) == brute(rows)
