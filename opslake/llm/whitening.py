"""Embedding whitening: spectrum slicing of the covariance.

Entries become integers, floor(``SCALE`` * c) + ``SHIFT``, so counts and sums are
exact. Spark adds up the centred products of all vectors, a partial matrix a
task. What follows works on that one matrix (dimensions squared, whatever the
rows): LDL' factors of the covariance minus a shift have as many positive
pivots as eigenvalues lie above the shift (Sylvester), so bisection of shifts
isolates each leading eigenvalue; Rayleigh quotient iteration then converges
cubically to it, and two more counts on either side of the result certify its
number. Eigenvalues closer than rounding can part are taken as one cluster: its
vectors are made by inverse iteration, each kept orthogonal to the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opslake.llm._common import read_table

SCALE, SHIFT = 1024.0, 100_000
COMPONENTS = 8
LARGEST = 2.0 ** 30  # entries from here on don't fit the exact sums
EPS = np.finfo(np.float64).eps


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are larger than ``shift``:
    positive pivots of the LDL' factors of matrix - shift, with Bunch-Kaufman
    pivoting (pivots of one or two rows)."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, positive, alpha = len(a), 0, 0, (1 + 17 ** 0.5) / 8
    while k < n:
        own = abs(a[k, k])
        column = np.abs(a[k + 1:, k])
        r = k + 1 + int(column.argmax()) if len(column) else k
        most = column.max() if len(column) else 0.0
        if own == 0 and most == 0:
            k += 1
            continue
        take, size = k, 1
        if own < alpha * most:
            others = np.abs(a[r, k:])
            others[r - k] = 0
            widest = others.max()
            if own * widest < alpha * most * most:
                take = r
                size = 1 if abs(a[r, r]) >= alpha * widest else 2
        to = k + size - 1
        if take != to:
            a[[to, take]] = a[[take, to]]
            a[:, [to, take]] = a[:, [take, to]]
        rest = a[k + size:, k:k + size]
        if size == 1:
            positive += a[k, k] > 0
            a[k + 1:, k + 1:] -= np.outer(rest, rest / a[k, k])
        else:
            block = a[k:k + 2, k:k + 2]
            det = block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0]
            positive += 1 if det < 0 else 2 if block[0, 0] + block[1, 1] > 0 else 0
            a[k + 2:, k + 2:] -= rest @ np.linalg.solve(block, rest.T)
        k += size
    return int(positive)


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and
    their unit eigenvectors as columns. Equal eigenvalues get some orthonormal
    basis of their space. Each vector's largest entry is positive."""
    n = len(matrix)
    wanted = min(wanted, n)
    norm = float(np.abs(matrix).sum(1).max()) if n else 0.0  # Gershgorin: no eigenvalue is beyond
    if norm == 0:
        return np.zeros(wanted), np.eye(n)[:, :wanted]
    tol = 4 * n * EPS * norm
    known = {2 * norm + 1: 0, -2 * norm - 1: n}  # eigenvalues above a shift
    values: list[float] = []
    vectors = np.zeros((n, 0))

    def bracket(k: int) -> tuple[float, float]:
        """The closest shifts with eigenvalue k (from 1) between them."""
        return max(s for s, c in known.items() if c >= k), min(s for s, c in known.items() if c < k)

    def halve(k: int) -> None:
        low, high = bracket(k)
        known[(low + high) / 2] = above(matrix, (low + high) / 2)

    def improved(x: np.ndarray, shift: float, apart: np.ndarray) -> np.ndarray:
        """One step of inverse iteration, orthogonal to the columns of ``apart``."""
        for nudge in (0.0, tol, -tol, 16 * tol + np.finfo(np.float64).tiny):
            try:
                y = np.linalg.solve(matrix - (shift + nudge) * np.eye(n), x)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(y).all() and y.any():
                x = y / np.abs(y).max()
                break
        for _ in range(2):
            x = x - apart @ (apart.T @ x)
        return x / np.linalg.norm(x)

    def residual(x: np.ndarray, value: float) -> float:
        return float(np.linalg.norm(matrix @ x - value * x))

    while len(values) < wanted:
        k = len(values) + 1
        low, high = bracket(k)
        while known[low] - known[high] > 1 and high - low > tol:
            halve(k)
            low, high = bracket(k)
        if known[low] - known[high] == 1:
            for _ in range(200):
                low, high = bracket(k)
                x = np.random.default_rng(k).standard_normal(n)
                for _ in range(3):
                    x = improved(x, (low + high) / 2, vectors)
                value = float(x @ matrix @ x)
                for _ in range(12):
                    if residual(x, value) <= n * EPS * norm:
                        break
                    x = improved(x, value, vectors[:, :0])
                    value = float(x @ matrix @ x)
                off = max(residual(x, value), tol)
                if low - tol <= value <= high + tol and off <= 16 * tol and (
                        above(matrix, value + 2 * off) == k - 1 and above(matrix, value - 2 * off) >= k):
                    break
                if high - low <= tol:
                    raise ArithmeticError(f"eigenvalue {k} could not be certified")
                halve(k)
            # Close neighbours: what is left of earlier vectors in this one goes.
            x = x - vectors @ (vectors.T @ x)
            vectors = np.column_stack([vectors, x / np.linalg.norm(x)])
            values.append(value)
            continue
        for k in range(k, min(known[low], wanted) + 1):  # a cluster
            x = np.random.default_rng(k).standard_normal(n)
            x -= vectors @ (vectors.T @ x)
            for _ in range(4):
                x = improved(x, (low + high) / 2, vectors)
            vectors = np.column_stack([vectors, x])
            values.append(float(x @ matrix @ x))
    order = np.argsort(-np.array(values), kind="stable")
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(values))]) if len(values) else np.ones(0)
    return np.array(values)[order], (vectors * sign)[:, order]


@dataclass
class Whitening:
    """What was learnt from ``n`` vectors: exact sums of their entries, the
    leading eigenvalues and unit eigenvectors (columns) of their covariance."""
    n: int = 0
    dim: int = 0
    sums: list[int] = field(default_factory=list)
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    trace: float = 0.0
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - mean. The mean's whole part goes first, as integers."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([s % self.n for s in self.sums], np.float64) / self.n
        return (x - whole).astype(np.float64) - part

    def scale(self) -> np.ndarray:
        """One over the standard deviation by component; 0 for components without spread."""
        real = self.values > 4 * self.dim * EPS * max(self.trace, 0.0)
        return np.where(real, 1 / np.sqrt(np.where(real, self.values, 1.0)), 0.0)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors * self.scale()

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - sums) ** 2, exactly; None beyond a long."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = [s % self.n for s in self.sums]
        d = x - whole
        widest = self.n * (int(np.abs(d).max()) + 1) if d.size else 0
        if widest ** 2 * max(1, self.dim) < 1 << 63:
            y = d * self.n - np.array(part, np.int64)
            return (y * y).sum(1).tolist()
        y = d.astype(object) * self.n - np.array(part, object)
        return [v if v < 1 << 63 else None for v in (y * y).sum(1)]


def usable(vector: Column) -> Column:
    """Whether a vector has entries, all of them numbers within the exact range."""
    return (F.size(vector) > 0) & F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < LARGEST), F.lit(False)))


def integers(column: pa.Array, dim: int) -> np.ndarray:
    """(rows, dim) integer entries of an Arrow list column of doubles."""
    c = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return np.floor(SCALE * c).astype(np.int64) + SHIFT


def _vectors(df: DataFrame, vector_col: str) -> DataFrame:
    v = F.col(f"`{vector_col}`").cast("array<double>")
    return df.select(v.alias("v")).where(usable(F.col("v")))


def fit(df: DataFrame, vector_col: str, components: int = COMPONENTS) -> Whitening:
    """Learn from all usable vectors. Vectors of another length than the most
    frequent one (the longer at a tie) take no part."""
    v = _vectors(df, vector_col)
    top = v.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if top is None:
        return Whitening()
    dim, n = top.dim, top.n
    v = v.where(F.size("v") == dim)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim, np.int64)
        for b in batches:
            total += integers(b.column(0), dim).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim), pa.int32()), pa.array(total)], ["i", "s"])

    rows = v.mapInArrow(sums, "i int, s long").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    model = Whitening(n, dim, [int(r.s) for r in sorted(rows)])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for b in batches:
            y = model.centred(integers(b.column(0), dim))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}  # matrix rows of this task, dim ** 2 numbers at most
        for b in batches:
            part = b.column(1).flatten().to_numpy().reshape(-1, dim)
            for i, row in zip(b.column(0).to_pylist(), part):
                total[i] = total[i] + row if i in total else row.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], ["i", "row"])

    kind = "i int, row array<double>"
    rows = v.mapInArrow(products, kind).repartition("i").mapInArrow(added, kind).collect()
    covariance = np.array([r.row for r in sorted(rows)]) / n
    covariance = (covariance + covariance.T) / 2
    model.trace = float(np.trace(covariance))
    model.values, model.vectors = leading(covariance, components)
    model.identity_error = _identity_error(v, model)
    return model


def _identity_error(v: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the
    identity, measured over all of them; components without spread don't count."""
    some = np.flatnonzero(model.scale())
    k, dim = len(some), model.dim

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for b in batches:
            z = model.whitened(integers(b.column(0), dim))[:, some]
            total[0] += z.sum(0)
            total[1:] += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], ["i", "m"])

    if not k:
        return 0.0
    rows = v.mapInArrow(moments, "i int, m double").groupBy("i").agg(F.sum("m").alias("m")).collect()
    m = np.array([r.m for r in sorted(rows)]).reshape(k + 1, k) / model.n
    return float(np.abs(m[1:] - np.outer(m[0], m[0]) - np.eye(k)).max())


def whiten(df: DataFrame, vector_col: str, model: Whitening, out_col: str = "whitened",
           deviation_col: str | None = None) -> DataFrame:
    """The rows of ``df`` whose vector is usable, with ``out_col``: the leading
    components of the vector, centred and scaled to unit variance (array of
    doubles), and ``deviation_col``: the exact squared deviation, if named.

    Defined cases: null vectors and those with null, non-finite or (from 2**30
    on) too large entries go, as do empty vectors and those of another length
    than the fitted ones; an entry of ``out_col`` is null where the component has
    no spread; a deviation beyond a long is null; equal vectors get equal values;
    an empty table gives an empty result; other columns stay, but one that has
    the name of an output column is replaced."""
    kind = "struct<w: array<double>, d: bigint>"
    dead = ~(model.scale() > 0)

    @F.arrow_udf(kind)
    def values(v: pa.Array) -> pa.Array:
        x = integers(v, model.dim)
        w = model.whitened(x)
        flat = pa.array(w.ravel(), mask=np.broadcast_to(dead, w.shape).ravel())
        offsets = pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32())
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, flat), pa.array(model.deviation(x), pa.int64())], ["w", "d"])

    v = F.col(f"`{vector_col}`").cast("array<double>")
    if not model.n:
        return df.where(F.lit(False)).withColumns({out_col: F.lit(None).cast("array<double>")}
                                                  | ({deviation_col: F.lit(None).cast("long")} if deviation_col else {}))
    rows = df.where(usable(v) & (F.size(v) == model.dim)).withColumn("__wh", values(v))
    out = {out_col: F.col("__wh.w")} | ({deviation_col: F.col("__wh.d")} if deviation_col else {})
    return rows.withColumns(out).drop("__wh")


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    """The eight leading whitened components of every vector, one row each."""
    df = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit(df, "embedding", COMPONENTS)
    share = F.array(*[F.lit(float(v / model.trace) if model.trace > 0 else 0.0) for v in model.values]) if model.n else F.lit(None).cast("array<double>")
    rows = whiten(df, "embedding", model, "w", "deviation").select(
        F.col("vec_id").cast("long").alias("vec_id"), "deviation", F.posexplode("w").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                       "whitened", F.get(share, F.col("at")).alias("explained"),
                       F.lit(model.identity_error).alias("identity_error"))
