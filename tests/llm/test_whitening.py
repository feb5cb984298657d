import numpy as np
import pytest

from rankforge.llm.whitening import COMPONENTS, Mean, components_of, polar_factor, to_integers, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec int, n int, component string"


def check(rows, got, components=COMPONENTS):
    """Hold the result against numpy's own eigenvalues of the same integers."""
    good = [(i, np.float32(e).astype(float)) for i, e in rows
            if e is not None and len(e) and all(x is not None and np.isfinite(x) for x in e)]
    by = {}
    for i, e in good:
        by.setdefault(len(e), []).append((i, np.floor(64 * e).astype(np.int64) + 1_000_000))
    want_rows = 0
    found = {}
    for r in got:
        found.setdefault((r.vec_id, r.component), []).append(r)
    for dim, own in by.items():
        x = np.array([v for _, v in own])
        n, k = len(x), min(components, dim)
        want_rows += n * k
        s = [int(v) for v in x.sum(axis=0)]
        centred = x - x.mean(axis=0)
        v = centred.T @ centred / n
        e = np.linalg.eigvalsh(v)[::-1][:k]
        dev = [sum((n * int(a) - b) ** 2 for a, b in zip(row, s)) for row in x]
        for (i, _), d in zip(own, dev):
            for c in range(1, k + 1):
                own_rows = [r for r in found[(i, c)] if r.n == n and r.deviation == d]
                assert own_rows
                if v.trace() > 0:
                    assert abs(own_rows[0].explained - e[c - 1] / v.trace()) <= 1e-9
        if n == 1:
            continue
        z = np.array([[next(r.whitened for r in found[(i, c)] if r.n == n and r.deviation == d) for c in range(1, k + 1)]
                      for (i, _), d in zip(own, dev)], dtype=float)
        there = ~np.isnan(z[0])
        assert (there == (e > 1e-11 * e[0])).all()
        if there.any() and len({i for i, _ in own}) == n:
            z = z[:, there]
            assert np.abs((z - z.mean(0)).T @ (z - z.mean(0)) / n - np.eye(z.shape[1])).max() < 1e-7
            # back from the components: v w = e w
            w = centred.T @ z / n / np.sqrt(e[there])
            assert np.abs(v @ w - w * e[there]).max() < 1e-8 * e[0]
            assert got[0].identity_error < 1e-7
    assert len(got) == want_rows


def make(n, dim, seed):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(dim, dim)) * np.linspace(1, 0.05, dim)
    return [(i, (rng.normal(size=dim) @ mix).tolist()) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 1, "x", 2, 3, "y") for i, e in rows], SCHEMA)


@pytest.mark.parametrize("n,dim", [(400, 48), (150, 5), (20, 40), (60, 1), (2, 3)])
def test_against_numpy(spark, n, dim):
    rows = make(n, dim, n)
    check(rows, whiten(frame(spark, rows).repartition(6)).collect())


def test_odd_rows(spark):
    rows = make(200, 6, 3)
    rows += [(1000, None), (1001, []), (1002, [None] * 6), (1003, [float("nan")] + [0.0] * 5), (1004, [float("inf")] * 6)]
    rows += [(1005, [1.0, 2.0]), (1006, [1.5, 2.0]), (1007, [-3.0, 0.5])] + [(1008, [9.0])]
    rows += [(2000 + i, rows[0][1]) for i in range(90)]
    got = whiten(frame(spark, rows).repartition(5)).collect()
    check(rows, got)
    one = [r for r in got if r.vec_id == 1008]
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, 0.0, 0.0)]


def test_repeated_and_null_ids(spark):
    rows = make(30, 4, 1)
    rows = [(None if i < 3 else i // 2, e) for i, e in rows]
    assert whiten(frame(spark, rows)).count() == 30 * 4
    assert whiten(frame(spark, rows)).where("vec_id is null").count() == 12


def test_constant_and_empty(spark):
    got = whiten(frame(spark, [(i, [0.5, 0.25]) for i in range(9)])).collect()
    assert len(got) == 18 and {(r.whitened, r.explained, r.deviation, r.identity_error) for r in got} == {(None, 0.0, 0, 0.0)}
    assert whiten(frame(spark, [])).count() == 0
    assert whiten(frame(spark, [(1, None), (2, [])])).count() == 0


def test_huge_entries(spark):
    rows = [(0, [3e38, -3e38]), (1, [1.0, 2.0]), (2, [-1.0, 5.0])]
    got = whiten(frame(spark, rows)).collect()
    assert len(got) == 6 and {r.deviation for r in got} == {None}
    assert to_integers(np.array([3e38, -3e38])).tolist() == [1 << 48, -(1 << 48)]


@pytest.mark.parametrize("low,high,n", [(0, 900, 400), (0, 1 << 30, 50), (-(1 << 48), 1 << 48, 7)])
def test_exact_deviations(low, high, n):
    rng = np.random.default_rng(n)
    x = rng.integers(low, high, size=(n, 9))
    s = [sum(c) for c in zip(*x.tolist())]
    want = [sum((n * a - b) ** 2 for a, b in zip(row, s)) for row in x.tolist()]
    assert Mean(n, s).deviation(x) == [w if w < 1 << 63 else None for w in want]


def test_spectrum_of_hard_matrices():
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.standard_normal((60, 60)))[0]
    spectra = [np.r_[np.ones(30), np.zeros(30)], np.r_[np.full(20, 5.0), np.full(20, 2.0), np.linspace(0, 1, 20)],
               10.0 ** -np.linspace(0, 12, 60), np.ones(60), 1 + 1e-13 * np.arange(60), np.zeros(60), np.arange(60.0) ** 3]
    for d in spectra:
        v = q @ np.diag(d) @ q.T
        e, w = components_of((v + v.T) / 2)
        top, scale = np.sort(d)[::-1][:32], max(d.max(), 1e-300)
        assert np.abs(e - top).max() <= 1e-13 * scale
        assert np.abs(w.T @ w - np.eye(32)).max() < 1e-13
        assert np.abs(v @ w - w * e).max() <= 1e-13 * scale


def test_polar_factor():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    e, w = np.linalg.eigh(a)
    assert np.abs(polar_factor(a) - w @ np.diag(np.sign(e)) @ w.T).max() < 1e-12
