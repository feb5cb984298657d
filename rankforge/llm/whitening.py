"""Embedding whitening by QDWH spectral divide-and-conquer (operator 11).

1. Every entry c becomes the integer x = floor(64 c) + 1000000.  One pass sums
   the x-vectors per dimension, exactly.
2. A second pass adds up the covariance matrix: each task centres its vectors
   by the exact mean before multiplying and returns one matrix.
3. The matrix is split by its spectrum.  The polar factor U of the covariance
   shifted by s has the eigenvalues +1 and -1, so (U + I) / 2 projects onto the
   eigenvectors with eigenvalues above s; an orthonormal basis of the
   projector's range and of its complement turns the matrix into two smaller
   ones, which are split in turn until a block is a multiple of the identity.
   U comes from the dynamically weighted Halley iteration (QDWH), by QR while
   the weights are large and by Cholesky factors after that; it takes about six
   rounds at any condition.  Subspaces below the components asked for are left
   whole.
4. The basis, scaled by the inverse square roots of the variances, goes to all
   tasks with the task function (vector length times components numbers).
5. A third pass measures the covariance of the whitened vectors, a fourth one
   writes them.

Only sums and matrices of the vectors' length ever leave a task.

Defined results: null vectors and vectors with null or non-finite entries are
left out, empty vectors have no components and give no rows; vectors of
different lengths are fitted apart, one model per length (n and all figures
are those of the length); x is held within +-2^48, so entries beyond 4.4e12 count
as the bound; a component whose variance is below 1e-11 of the largest has no
direction that double precision can scale, its ``whitened`` is null and it
doesn't count in ``identity_error``; ``deviation`` is null where it does not
fit a long; a sign is fixed by the component's largest entry; rows that repeat
an id are separate rows; other columns are not read.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.shared import frugal

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Bound of x; sums over a block of vectors stay exact in 64 bits.
LARGEST = 1 << 48
BLOCK = 8192
#: Share of the largest variance below which a component has none.
NONE = 1e-11

_EPS = np.finfo(np.float64).eps


# ---------------------------------------------------------------- spectrum

def polar_factor(a: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QDWH iterations."""
    m = len(a)
    x = a / np.sqrt((a * a).sum())
    try:
        low = 1 / np.sqrt((np.linalg.inv(x) ** 2).sum())        # at most the smallest singular value
    except np.linalg.LinAlgError:
        low = 0.0
    low = min(1.0, max(float(low) if np.isfinite(low) else 0.0, 1e-20))
    eye = np.eye(m)
    for _ in range(rounds):
        d = np.cbrt(4 * (1 - low * low) / low ** 4) if low < 1 else 0.0
        p = np.sqrt(1 + d)
        wa = p + np.sqrt(max(8 - 4 * d + 8 * (2 - low * low) / (low * low * p), 0.0)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))[0]
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:m] @ q[m:].T)
        else:
            low_tri = np.linalg.cholesky(eye + wc * (x.T @ x))
            half = np.linalg.solve(low_tri, x.T)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(low_tri.T, half).T
        new = (new + new.T) / 2
        change, x = np.sqrt(((new - x) ** 2).sum()), new
        low = min(1.0, low * (wa + wb * low * low) / (1 + wc * low * low))
        if change < 4 * _EPS ** (1 / 3) * np.sqrt(m) * 1e-3 and 1 - low < 1e-14:
            break
    return x


def _split(a: np.ndarray, scale: float, rng) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenvectors above and below a shift; None if
    no shift separates the eigenvalues."""
    m, best, least = len(a), None, np.inf
    mean = np.trace(a) / m
    spread = np.sqrt(((a - mean * np.eye(m)) ** 2).sum() / m)
    shifts = [np.median(np.diag(a)), mean, *(mean + spread * rng.uniform(-0.9, 0.9, 12))]
    for s in shifts:
        shifted = a - s * np.eye(m)
        if not shifted.any():
            continue
        projector = (polar_factor(shifted) + np.eye(m)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < m:
            continue
        q = np.linalg.qr(projector @ rng.standard_normal((m, k)), mode="complete")[0]
        left = np.abs(q[:, k:].T @ a @ q[:, :k]).max()
        if left < least:
            best, least = (q[:, :k], q[:, k:]), left
        if least <= 8 * _EPS * scale:
            break
    return best


def _divide(a: np.ndarray, want: int, scale: float, rng) -> list[np.ndarray]:
    m = len(a)
    rest = a - np.trace(a) / m * np.eye(m)
    if m == 1 or np.abs(rest).max() <= _EPS * scale:
        return [np.eye(m)]
    bases = _split(a, scale, rng)
    if bases is None:                                             # eigenvalues that rounding can't tell apart
        return [np.eye(m)]
    out, above = [], 0
    for q in bases:
        if above >= want:
            break
        b = q.T @ a @ q
        out += [q @ w for w in _divide((b + b.T) / 2, want - above, scale, rng)]
        above += q.shape[1]
    return out


def components_of(v: np.ndarray, want: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` largest eigenvalues of a covariance matrix, falling, and
    their unit eigenvectors as columns."""
    m = len(v)
    v = (v + v.T) / 2
    scale = float(np.sqrt((v * v).sum()))
    if scale == 0:
        return np.zeros(min(want, m)), np.eye(m)[:, :want]
    w = np.linalg.qr(np.hstack(_divide(v, min(want, m), scale, np.random.default_rng(11))))[0]
    e = np.einsum("ij,ij->j", w, v @ w)
    order = np.argsort(-e, kind="stable")[:want]
    w, e = w[:, order], np.maximum(e[order], 0.0)
    return e, w * np.where(w[np.abs(w).argmax(axis=0), np.arange(w.shape[1])] < 0, -1.0, 1.0)


# ------------------------------------------------------------------ passes

def to_integers(c: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * c) + SHIFT, -LARGEST, LARGEST).astype(np.int64)


def _by_length(batch: pa.RecordBatch):
    """(vector length, row numbers, integer vectors) for each length in blocks."""
    column = batch.column(batch.schema.get_field_index("vec"))
    off = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    size = np.diff(off)
    for dim in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == dim)
        for i in range(0, len(rows), BLOCK):
            part = rows[i:i + BLOCK]
            yield dim, part, to_integers(flat[off[part][:, None] + np.arange(dim)])


class Mean:
    """Exact mean of n integer vectors: S = n q + r."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n = n
        self.q = np.array([s // n for s in sums], dtype=np.int64)
        self.r = [s % n for s in sums]
        self.part = np.array([r / n for r in self.r])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.q).astype(np.float64) - self.part

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """sum over dimensions of (n x - S)^2 = n^2 A - 2 n B + C, exactly."""
        d, n = x - self.q, self.n
        most, dims, c = int(np.abs(d).max(initial=0)), x.shape[1], sum(r * r for r in self.r)
        if dims * most * most < 1 << 62 and dims * most * n < 1 << 62:
            a, b = (d * d).sum(axis=1), d @ np.array(self.r, dtype=np.int64)
            if n * n * dims * most * most + 2 * n * dims * most * n + c < 1 << 63:
                return (n * n * a - 2 * n * b + c).tolist()
            out = [n * n * i - 2 * n * j + c for i, j in zip(a.tolist(), b.tolist())]
        else:
            out = [sum((n * i - r) ** 2 for i, r in zip(row, self.r)) for row in d.tolist()]
        return [v if v < 1 << 63 else None for v in out]


def _slim(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    good = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return table.select(F.col(id_col).alias("id"), v.alias("vec")).where(F.col("vec").isNotNull() & good)


def _sums(batches):
    total: dict[int, list[int]] = {}
    count: dict[int, int] = {}
    for batch in batches:
        for dim, rows, x in _by_length(batch):
            old = total.get(dim, [0] * dim)
            total[dim] = [a + b for a, b in zip(old, x.sum(axis=0).tolist())]
            count[dim] = count.get(dim, 0) + len(rows)
    for dim, s in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()),
             pa.array([Decimal(v) for v in s], pa.decimal128(38, 0)), pa.array([count[dim]] * dim, pa.int64())],
            ["dim", "i", "s", "n"])


def _squares(vectors_of):
    """Sum of the outer products of ``vectors_of(dim, x)``; one matrix by task
    and length, a row of it by row."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _by_length(batch):
                y = vectors_of(dim, x)
                total[dim] = total.get(dim, 0) + y.T @ y
        for dim, m in total.items():
            k = len(m)
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * k, pa.int32()), pa.array(range(k), pa.int32()),
                 pa.array(list(m), pa.list_(pa.float64()))], ["dim", "i", "m"])
    return run


def _matrices(slim: DataFrame, vectors_of) -> dict[int, np.ndarray]:
    rows = slim.select("vec").mapInArrow(frugal(_squares(vectors_of)), "dim int, i int, m array<double>")
    added = rows.select("dim", "i", F.posexplode("m").alias("j", "v")).groupBy("dim", "i", "j").agg(F.sum("v").alias("v")) \
        .groupBy("dim", "i").agg(F.array_sort(F.collect_list(F.struct("j", "v"))).alias("m"))
    out: dict[int, np.ndarray] = {}
    for r in added.collect():
        out.setdefault(r.dim, np.zeros((len(r.m), len(r.m))))[r.i] = [x.v for x in r.m]
    return out


def mean_of(slim: DataFrame) -> dict[int, Mean]:
    rows = slim.select("vec").mapInArrow(frugal(_sums), "dim int, i int, s decimal(38,0), n long") \
        .groupBy("dim", "i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    sums: dict[int, list[int]] = {}
    count = {}
    for r in rows:
        sums.setdefault(r.dim, [0] * r.dim)[r.i] = int(r.s)
        count[r.dim] = r.n
    return {dim: Mean(count[dim], s) for dim, s in sums.items()}


def whiten(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: id, component, n, deviation, whitened,
    explained, identity_error."""
    slim = _slim(table, id_col, vec_col)
    means = mean_of(slim)
    covariance = {dim: m / means[dim].n for dim, m in _matrices(slim, lambda dim, x: means[dim].centred(x)).items()}
    basis, explained = {}, {}
    for dim, v in covariance.items():
        e, w = components_of(v, components)
        there = e > NONE * e[0]
        basis[dim] = w * np.where(there, 1 / np.sqrt(np.where(there, e, 1.0)), np.nan)
        explained[dim] = e / np.trace(v) if np.trace(v) > 0 else np.zeros(len(e))
    scaled = {dim: np.where(np.isnan(b), 0.0, b) for dim, b in basis.items()}

    def project(dim: int, x: np.ndarray) -> np.ndarray:
        return means[dim].centred(x) @ scaled[dim]

    error = {}
    for dim, m in _matrices(slim, project).items():               # the projections are centred already
        there = ~np.isnan(basis[dim][0])
        off = np.abs(m / means[dim].n - np.eye(len(m)))[np.ix_(there, there)]
        error[dim] = float(off.max(initial=0.0))

    def write(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("id"))
            for dim, rows, x in _by_length(batch):
                z, k = project(dim, x), scaled[dim].shape[1]
                gone = np.broadcast_to(np.isnan(basis[dim][0]), z.shape)
                take = pa.array(np.repeat(rows, k))
                deviation = pa.array(means[dim].deviation(x), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                     pa.array(np.full(len(take), means[dim].n)), deviation.take(pa.array(np.repeat(np.arange(len(rows)), k))),
                     pa.array(z.ravel(), mask=gone.ravel()), pa.array(np.tile(explained[dim], len(rows))),
                     pa.array(np.full(len(take), error[dim]))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = slim.schema["id"].dataType.simpleString()
    out = slim.mapInArrow(frugal(write), f"id {kind}, component int, n long, deviation long, whitened double, "
                                         "explained double, identity_error double")
    return out.withColumnRenamed("id", id_col)


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
