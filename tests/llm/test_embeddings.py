import numpy as np
import pytest

from rankforge.llm.embeddings import near_vectors
from rankforge.llm.graph import components

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, row string"


def brute(rows, t=0.93):
    ok, unit = [], []
    for r in rows:
        e = r[1]
        good = r[2] is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)
        ok.append(bool(good))
        unit.append(np.float32(e).astype(float) / np.linalg.norm(np.float32(e).astype(float)) if good else None)
    n = len(rows)
    link = [[j for j in range(n) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2]
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= t] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        comp = min(rows[j][0] for j in seen)
        out.append((rows[i][0], len(link[i]), comp, comp == rows[i][0]))
    return sorted(out)


def make(seed, n, dim=8, spread=0.25):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, dim))
    rows = [(i * 3 % 1000, (centre[i % 6] + rng.normal(size=dim) * spread * rng.random()).tolist(), i % 2, "x", "y")
            for i in range(n)]
    rows += [(2000 + i, rows[0][1], 0, None, "y") for i in range(40)]
    rows += [(3000, None, 0, "x", "y"), (3001, [], 0, "x", "y"), (3002, [0.0] * dim, 0, "x", "y"),
             (3003, [float("nan")] * dim, 0, "x", "y"), (3004, [None] + [1.0] * (dim - 1), 0, "x", "y"),
             (3005, [float("inf")] * dim, 1, "x", "y"), (3006, rows[0][1], None, "x", "y"), (3007, rows[0][1][:3], 0, "x", "y"),
             (3008, [2 * x for x in rows[0][1]], 0, "x", "y"), (3009, rows[1][1], 1, "x", "y"), (3009, rows[1][1], 1, "x", "y")]
    return rows


@pytest.mark.parametrize("cell,block", [(20, 30), (1000, 2048), (7, 500)])
def test_against_brute_force(spark, cell, block):
    rows = make(cell, 260)
    got = near_vectors(spark.createDataFrame(rows, SCHEMA), cell_size=cell, block=block)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_extreme_magnitudes(spark):
    """Lengths whose squares are beyond a double don't matter."""
    rows = [(1, [1e-200, 1e-200], 0), (2, [1.0, 0.2], 0), (3, [0.2, 1.0], 0), (4, [1e300, 1e300], 0), (5, [5e-324, 0.0], 0),
            (6, [1e308, -1e308], 0), (7, [1e-160, -1e-160], 0), (8, [3.0, 3.0], 0)]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert sorted(tuple(r)[:3] for r in got.collect()) == [(1, 2, 1), (2, 1, 2), (3, 0, 3), (4, 2, 1), (5, 1, 2), (6, 1, 6), (7, 1, 6), (8, 2, 1)]


def test_empty(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_a_path_and_a_star(spark):
    rng = np.random.default_rng(1)
    ids = rng.permutation(3000).tolist()
    edges = list(zip(ids[:500], ids[1:501])) + [(ids[600], x) for x in ids[601:2000]]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(9)).collect()}
    want = {x: min(ids[:501]) for x in ids[:501]} | {x: min(ids[600:2000]) for x in ids[600:2000]}
    assert got == want
