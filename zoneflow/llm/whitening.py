"""Embedding whitening by shifted CholeskyQR: distributed Gram passes orthogonalise the
centred rows again and again through triangular solves, the R factors are composed, and the
singular value decomposition of R gives the components.

Only d x d matrices and sums of d numbers leave the tasks (d is the dimension of the vectors);
rows stay in a written table that every pass reads anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import written

SCALE = 256
COMPONENTS = 4
PASSES = 10              # Gram passes at most; three are enough unless rows are close to dependent
LARGEST = float(1 << 53)  # scaled entries beyond +-2^53 are no exact integers
UNIT = 2.0 ** -53


@dataclass(frozen=True)
class Whitening:
    """A fit over ``n`` distinct vectors of one dimension."""
    n: int
    sums: tuple               # exact sums of the integer entries, by place
    components: np.ndarray    # (d, k), unit columns by falling eigenvalue
    eigenvalues: np.ndarray   # (k,)
    trace: float              # of the covariance
    passes: int


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, x``: floor(scale * c) of every entry as array<long>. Null and empty vectors and
    those with a null or non-finite entry, or one beyond +-2^53 after scaling, are left out."""
    c = F.transform("embedding", lambda v: v.cast("double") * scale)
    good = (F.size("embedding") > 0) & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) <= LARGEST))
    kept = vectors.select("vec_id", F.when(F.coalesce(good, F.lit(False)), c).alias("x")).where("x is not null")
    return kept.select("vec_id", F.transform("x", lambda v: F.floor(v).cast("long")).alias("x"))


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim)


def _exact_sums(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dim  # Python integers: no overflow
        for b in batches:
            x = _matrix(b, dim)
            high, low = (x >> 26).sum(axis=0), (x & ((1 << 26) - 1)).sum(axis=0)
            total = [t + (int(h) << 26) + int(v) for t, h, v in zip(total, high, low)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([str(t) for t in total], pa.string())], names=["i", "v"])
    return run


def exact_sums(fit: DataFrame, dim: int) -> tuple:
    """Sum of every place over all rows, as Python integers."""
    parts = fit.select("x").mapInArrow(_exact_sums(dim), "i int, v string")
    rows = parts.groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    return tuple(int(v) for _, v in sorted((r["i"], r["v"]) for r in rows)) or (0,) * dim


def deviations(x: np.ndarray, n: int, sums: tuple) -> np.ndarray:
    """n * x - S, exact: as longs where they fit, else as Python integers."""
    widest = n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in sums), default=0)
    if widest < 1 << 62:
        return n * x - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def centred(x: np.ndarray, n: int, sums: tuple) -> np.ndarray:
    """x - S / n in doubles, from the exact integer difference."""
    return (deviations(x, n, sums) / n).astype(np.float64)


def triangular_solve(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """x R^-1 for an upper triangular R, column by column for all rows at once."""
    q = np.empty_like(x)
    for j in range(r.shape[1]):
        q[:, j] = (x[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def gram(fit: DataFrame, dim: int, n: int, sums: tuple, factors: list[np.ndarray]) -> np.ndarray:
    """Q^T Q of the centred rows after a triangular solve with each factor: one partial matrix a
    task, added up place by place on Spark."""
    shared = fit.sparkSession.sparkContext.broadcast(factors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for b in batches:
            q = centred(_matrix(b, dim), n, sums)
            for r in shared.value:
                q = triangular_solve(q, r)
            total += q.T @ q
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([pa.array(i * dim + j, pa.int64()), pa.array(total[i, j])], names=["at", "v"])
    rows = fit.select("x").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(dim * dim)
    out[[r["at"] for r in rows]] = [r["v"] for r in rows]
    out = out.reshape(dim, dim)
    return np.triu(out) + np.triu(out, 1).T


def shifted_cholesky(g: np.ndarray, shifted: bool) -> np.ndarray:
    """Upper R with R^T R = G + s I. The shift s is a small multiple of the rounding of G if
    ``shifted`` or G is badly conditioned, else 0, and rises until the factorisation succeeds."""
    d = len(g)
    norm = float(np.linalg.norm(g, 2)) or 1.0
    least = 11 * (d * d + d * (d + 1)) * UNIT * norm
    shift = least if shifted or np.linalg.eigvalsh(g)[0] < 1e-3 * norm else 0.0
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, least)


def cholesky_qr(pass_: Callable[[list[np.ndarray]], np.ndarray], passes: int = PASSES) -> tuple[np.ndarray, list[np.ndarray]]:
    """R of the centred rows, and its factors. ``pass_`` gives the Gram matrix after solving with
    the factors so far. Every pass moves the singular values of Q towards 1; those of directions
    without any spread stay 0 and the shift makes their share of R vanish."""
    factors: list[np.ndarray] = []
    for _ in range(passes):
        g = pass_(factors)
        factors.append(shifted_cholesky(g, shifted=not factors))
        values = np.linalg.eigvalsh(g)
        if len(factors) >= 3 and np.all((np.abs(values - 1) < 1e-10) | (values < 1e-10)):
            break
    r = factors[0]
    for f in factors[1:]:
        r = f @ r
    return np.triu(r), factors


def fit_whitening(fit: DataFrame, dim: int, k: int = COMPONENTS) -> Whitening:
    """The fit over ``fit`` (a written table ``x`` of distinct vectors of ``dim`` entries)."""
    n = fit.count()
    sums = exact_sums(fit, dim)
    r, factors = cholesky_qr(lambda f: gram(fit, dim, n, sums, f))
    _, sigma, vt = np.linalg.svd(r)
    rank = int((sigma > 1e-12 * sigma[0]).sum()) if n > 1 and sigma[0] > 0 else 0
    values = sigma ** 2 / n
    w = vt[:min(k, rank)].T
    w = w * np.where(w[np.abs(w).argmax(axis=0), np.arange(w.shape[1])] < 0, -1.0, 1.0)[None, :] if w.size else w.reshape(dim, 0)
    return Whitening(n, sums, w, values[:w.shape[1]], float(values.sum()), len(factors))


def _projected(m: Whitening, dim: int, exact: bool):
    """Arrow rows of ``vec_id`` (if there), ``whitened`` and, with ``exact``, ``deviation``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b, dim)
            z = (centred(x, m.n, m.sums) @ m.components) / np.sqrt(m.eigenvalues)[None, :]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * z.shape[1], pa.int32()), pa.array(z.ravel(), pa.float64()))
            if not exact:
                yield pa.RecordBatch.from_arrays([lists], names=["whitened"])
                continue
            far = deviations(x, m.n, m.sums)
            if dim * max(abs(int(far.max(initial=0))), abs(int(far.min(initial=0)))) ** 2 < 1 << 63:
                deviation = pa.array((far ** 2).sum(axis=1).astype(np.int64), pa.int64())
            else:
                each = [sum(v * v for v in row) for row in far.astype(object).tolist()]
                deviation = pa.array([v if v < 1 << 63 else None for v in each], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), deviation, lists], names=["vec_id", "deviation", "whitened"])
    return run


def identity_error(fit: DataFrame, m: Whitening, dim: int) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity,
    measured by passes over the list: means first, then products of the centred values."""
    k = len(m.eigenvalues)
    if not k:
        return 0.0
    rows = fit.select("x").mapInArrow(_projected(m, dim, False), "whitened array<double>").select(*[F.col("whitened")[i].alias(f"w{i}") for i in range(k)])
    means = rows.agg(*[F.avg(f"w{i}").alias(f"w{i}") for i in range(k)]).first()
    away = [F.col(f"w{i}") - F.lit(float(means[f"w{i}"])) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = rows.agg(*[F.avg(away[i] * away[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


SCHEMA = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, k: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Whitened values of every row of ``vectors`` (``vec_id, embedding``) on the first ``k``
    components: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Entries become floor(scale * c). The fit list holds every distinct vector once, so copies
    (one vector may be a third of all rows) weigh nothing; all rows are returned, repeated ids
    and null ids too. Vectors that are null, empty, or have null, non-finite or (after scaling)
    not exactly representable entries are left out. Vectors of different dimensions are fitted
    apart. Components stop at the rank of the fit list: one distinct vector, or an empty table,
    gives no rows. ``deviation`` is null where it exceeds a long. Equal eigenvalues leave their
    components free, as any basis of their space. Other columns are ignored whatever their names.
    """
    id_type = dict(vectors.dtypes)["vec_id"]
    ints = written(integer_vectors(vectors, scale), "whiten-integers")
    out = vectors.sparkSession.createDataFrame([], SCHEMA.format(id_type))
    for dim in sorted(r["d"] for r in ints.select(F.size("x").alias("d")).distinct().collect()):
        rows = ints.where(F.size("x") == dim)
        fit = written(rows.select("x").distinct(), "whiten-fit")
        m = fit_whitening(fit, dim, k)
        if not len(m.eigenvalues):
            continue
        error = identity_error(fit, m, dim)
        values = rows.mapInArrow(_projected(m, dim, True), f"vec_id {id_type}, deviation long, whitened array<double>")
        shares = F.array(*[F.lit(float(e / m.trace)) for e in m.eigenvalues])
        each = values.select("vec_id", "deviation", F.posexplode("whitened").alias("_p", "whitened"))
        out = out.unionByName(each.select(
            "vec_id", (F.col("_p") + 1).alias("component"), F.lit(m.n).cast("long").alias("n"), "deviation", "whitened",
            F.element_at(shares, F.col("_p") + 1).alias("explained"), F.lit(float(error)).alias("identity_error")))
    return out
