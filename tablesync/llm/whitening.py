"""Operator 13: whitening of embeddings by shifted CholeskyQR.

Components become x = floor(256 * c).  The fit list holds each distinct vector
once; n is its length, S its sums by dimension.  Its centred rows A are never
gathered: a pass over them adds up Gram matrices block by block in the tasks,
and only the sums, one number for each pair of dimensions, come to the driver.

Pass 1 factors the Gram matrix plus a shift that keeps it positive; each later
pass solves the rows by the triangular factors found so far and
factors the Gram matrix of what that gives, shifted again while it
is ill-conditioned, until the rows are orthonormal (or zero in directions that the
vectors don't span).  With R the product of the factors and G the last Gram
matrix, A'A = R' G R, so the singular values and right vectors of sqrt(G) R are
those of A: squared over n the eigenvalues of the covariance, and its components.

Whitened rows are checked by one more pass, whose blocks are centred before
they are multiplied and merged by the difference of their means.

Defined cases: rows with a null vector or a null or non-finite component
take no part, nor do empty vectors; rows that repeat, null ids included, each
get their rows but count once in the fit list; vectors of different lengths
are whitened apart; a component has no row where its eigenvalue is zero (copies
of one vector alone have none); a deviation beyond 64 bits is null; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Rows that are multiplied at once.
ROWS = 4096
#: Passes after which the factors are taken as they are (they converge in two to four).
PASSES = 12
#: Entries of the Gram matrix of orthonormal rows differ from the identity by less.
ORTHONORMAL = 1e-11
#: Share of a Gram matrix's largest eigenvalue below which a direction counts as not
#: spanned.  A shifted pass raises what is spanned far above that, however small it was.
SPANNED = 1e-12
#: Share of the largest eigenvalue of the covariance below which one counts as zero.
RANK = 1e-22
UNIT = float(np.finfo(float).eps) / 2


def whole_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id``, ``x`` (array of long) and its length ``d`` of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    df = vectors.filter(F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)) & (F.size(vector) > 0))
    x = F.transform(v, lambda c: F.floor(c * 256))
    return df.select(F.col(key).alias("vec_id"), x.alias("x"), F.size(vector).alias("d"))


@dataclass
class Space:
    """What is known of the vectors of one length."""

    n: int
    sums: list[int]
    factors: list[np.ndarray] = field(default_factory=list)
    values: np.ndarray | None = None
    components: np.ndarray | None = None
    total: float = 0.0
    error: float = 0.0

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _matrices(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(batch, length, rows in the batch, their vectors) in blocks of ``ROWS``."""
    for b in batches:
        lists = b.column(column)
        size = lists.value_lengths().to_numpy(zero_copy_only=False)
        values = lists.flatten().to_numpy(zero_copy_only=False)
        start = np.concatenate([[0], np.cumsum(size)])
        for d in np.unique(size):
            own = np.flatnonzero(size == d)
            for lo in range(0, len(own), ROWS):
                some = own[lo : lo + ROWS]
                yield b, int(d), some, values[(start[some][:, None] + np.arange(d)).ravel()].reshape(len(some), d)


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """rows R1^-1 R2^-1 ... by forward substitution, all rows at once."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(len(r)):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def _gram(fit: DataFrame, spaces: dict[int, Space]) -> dict[int, np.ndarray]:
    """Gram matrix of the solved centred rows of each space: a pass over the fit list."""
    known = {d: (s.mean(), s.factors) for d, s in spaces.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for _, d, _, x in _matrices(batches):
            mean, factors = known[d]
            a = solved(x - mean, factors)
            sums[d] = sums.get(d, 0.0) + a.T @ a
        for d, g in sums.items():
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(g[i, j])], names=["d", "i", "j", "g"])

    parts = fit.select("x").mapInArrow(work, "d int, i int, j int, g double")
    out = {d: np.zeros((d, d)) for d in spaces}
    sums = parts.groupBy("d", "i", "j").agg(F.sum("g").alias("g")).toArrow()  # a number for each pair of dimensions
    size, i, j, g = [sums.column(c).to_numpy() for c in ("d", "i", "j", "g")]
    for d, whole in out.items():
        own = size == d
        whole[i[own], j[own]] = whole[j[own], i[own]] = g[own]
    return out


def _factor(s: Space, g: np.ndarray, first: bool) -> bool:
    """Take the next triangular factor from a Gram matrix; False if the rows are done."""
    d = len(g)
    at = np.linalg.eigvalsh(g)
    most = at[-1]
    if most <= 0:
        return False
    spanned = at > SPANNED * most
    if not first and np.all(np.abs(at[spanned] - 1) < ORTHONORMAL):
        return False
    shift = 11 * (s.n * d + d * (d + 1)) * UNIT * most
    if not first and spanned.all() and at[0] > 1e-3 * most:
        shift = 0.0
    s.factors.append(np.linalg.cholesky(g + shift * np.eye(d)).T)
    return True


def orthogonalise(fit: DataFrame, spaces: dict[int, Space]) -> None:
    """Shifted CholeskyQR of the centred fit list, then eigenvalues and components."""
    live = dict(spaces)
    gram: dict[int, np.ndarray] = {}
    for at in range(PASSES + 1):
        gram |= _gram(fit if len(live) == len(spaces) else fit.filter(F.size("x").isin(list(live))), live)
        if at == 0:
            for d, s in live.items():
                s.total = float(np.trace(gram[d])) / s.n
        if at < PASSES:
            live = {d: s for d, s in live.items() if _factor(s, gram[d], at == 0)}
        if not live or at == PASSES:
            break
    for d, s in spaces.items():
        r = np.eye(d)
        for one in s.factors:
            r = one @ r
        w, u = np.linalg.eigh(gram[d])
        root = np.sqrt(np.where(w > SPANNED * w[-1], w, 0.0).clip(0))
        _, sigma, vt = np.linalg.svd((u * root) @ u.T @ r)
        values = sigma**2 / s.n
        keep = values > RANK * values[0]
        s.values, s.components = values[keep], vt[keep]
        # one sign for all rows: the strongest entry is positive
        for v in s.components:
            v *= np.sign(v[np.abs(v).argmax()]) or 1.0


def whiten(x: np.ndarray, mean: np.ndarray, components: np.ndarray, values: np.ndarray) -> np.ndarray:
    return (x - mean) @ components.T / np.sqrt(values)


def check(fit: DataFrame, spaces: dict[int, Space], k: int) -> None:
    """Largest entry by which the covariance of the whitened fit list misses the identity."""
    known = {d: (s.mean(), s.components[:k], s.values[:k]) for d, s in spaces.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for _, d, _, x in _matrices(batches):
            w = whiten(x, *known[d])
            mean = w.mean(axis=0)
            held[d] = _merge(held.get(d), (len(w), mean, (w - mean).T @ (w - mean)))
        for d, (n, mean, second) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([n], pa.int64()), pa.array([mean.tolist()], pa.list_(pa.float64())), pa.array([second.ravel().tolist()], pa.list_(pa.float64()))], names=["d", "n", "mean", "second"])

    parts = fit.select("x").mapInArrow(work, "d int, n long, mean array<double>, second array<double>")
    sums: dict[int, tuple] = {}
    for r in parts.collect():  # k * (k + 1) numbers a task
        m = len(r["mean"])
        sums[r["d"]] = _merge(sums.get(r["d"]), (r["n"], np.array(r["mean"]), np.array(r["second"]).reshape(m, m)))
    for d, (n, _, second) in sums.items():
        spaces[d].error = float(np.abs(second / n - np.eye(len(second))).max()) if second.size else 0.0


def _merge(a: tuple | None, b: tuple) -> tuple:
    """(rows, mean, centred products) of two sets together."""
    if a is None:
        return b
    n, gap = a[0] + b[0], b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exactly (null beyond 64 bits)."""
    most = float(n) * float(np.abs(x.astype(float)).max()) + max(abs(float(s)) for s in sums)
    if most * most * x.shape[1] < 2.0**62:
        gap = n * x - np.array(sums, np.int64)
        return pa.array((gap * gap).sum(axis=1))
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def fit_whitening(rows: DataFrame, k: int) -> dict[int, Space]:
    """The whitening of each length of vectors in ``rows`` (``x``)."""
    fit = materialise(rows.select("x").dropDuplicates(), "whitening-fit")
    # sums as decimals: exact for any number of 64-bit entries
    exact = fit.select(F.size("x").alias("d"), F.posexplode("x").alias("i", "c")).groupBy("d", "i").agg(F.sum(F.col("c").cast("decimal(20,0)")).alias("s"), F.count("*").alias("n"))
    spaces: dict[int, Space] = {}
    for r in exact.orderBy("d", "i").toLocalIterator():
        spaces.setdefault(r["d"], Space(r["n"], [])).sums.append(int(r["s"]))
    if spaces:
        orthogonalise(fit, spaces)
        check(fit, spaces, k)
    return spaces


def whitened_rows(vectors: DataFrame, k: int = 4, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Each remaining row on each of the first ``k`` components."""
    rows = whole_vectors(vectors, key, vector)
    kind = rows.schema["vec_id"].dataType.simpleString()
    spaces = fit_whitening(rows, k)
    known = {d: (s.n, s.sums, s.mean(), s.components[:k], s.values[:k], s.total, s.error) for d, s in spaces.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, d, some, x in _matrices(batches, 1):
            n, sums, mean, components, values, total, error = known[d]
            m = len(values)
            if not m:
                continue
            many = len(some) * m
            at = pa.array(np.repeat(np.arange(len(some)), m))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(some)).take(at), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(some))), pa.array(np.full(many, n, np.int64)),
                    deviations(x, n, sums).take(at), pa.array(whiten(x, mean, components, values).ravel()), pa.array(np.tile(values / total, len(some))), pa.array(np.full(many, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select("vec_id", "x").mapInArrow(work, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
