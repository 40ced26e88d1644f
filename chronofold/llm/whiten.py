"""Whitening of embeddings: blockwise QR of the centred rows, a bidiagonal form, dqds and twisted factorisations.

The rows never meet in one place: every task reduces its centred rows to one triangular factor, factors are combined in
a tree of tasks, and only the last one, of dimension x dimension, reaches the driver.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.common import mapped
from chronofold.llm.scratch import Scratch

COMPONENTS = 4
#: Entries are counted in steps of one part in so many.
SCALE = 256
#: States that one task of the combining tree takes together.
FAN = 16
#: Rows that enter a QR step together.
BLOCK_ROWS = 4096
_WIDTHS = (np.int16, np.int32, np.int64)
_LONG = (1 << 63) - 1


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and upper diagonal of the bidiagonal form of a square matrix, and the reflectors applied from the right."""
    r, d = r.astype(float).copy(), len(r)
    right = []

    def reflector(x: np.ndarray) -> np.ndarray:
        u = x.copy()
        u[0] += math.copysign(np.linalg.norm(x), x[0])
        length = np.linalg.norm(u)
        return u / length if length else u

    for k in range(d):
        u = reflector(r[k:, k])
        r[k:, k:] -= 2 * np.outer(u, u @ r[k:, k:])
        if k < d - 1:
            u = reflector(r[k, k + 1 :])
            r[k:, k + 1 :] -= 2 * np.outer(r[k:, k + 1 :] @ u, u)
            right.append(u)
    return np.diag(r).copy(), np.diag(r, 1).copy(), right


def dqds(q: list[float], e: list[float]) -> list[float]:
    """Eigenvalues of B'B in falling order, B bidiagonal with squared diagonal ``q`` and squared upper diagonal ``e``.

    Differential quotient-difference steps with shifts that never pass the smallest eigenvalue: the larger of Newton's bound
    (one over the trace of the inverse) and Gershgorin's.  A negligible ``e`` cuts the matrix in two.
    """
    eps = np.finfo(float).eps
    least = max([*q, *e], default=0.0) * 1e-290 or 1e-290
    blocks = [([max(x, least) for x in q], list(e), 0.0)]
    found = []
    while blocks:
        q, e, shifted = blocks.pop()
        while len(q) > 1:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= eps * eps * (shifted + min(q[i], q[i + 1]))), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], shifted))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            f = total = 0.0
            gershgorin = math.inf
            for i, x in enumerate(q):
                before = e[i - 1] if i else 0.0
                f = (1 + before * f) / x
                total += f
                gershgorin = min(gershgorin, x + before - (math.sqrt(q[i - 1] * before) if i else 0) - (math.sqrt(x * e[i]) if i < len(e) else 0))
            shift = max(1 / total if math.isfinite(total) else 0.0, gershgorin, 0.0) * (1 - 4 * eps)
            while True:
                after_q, after_e, d = [], [], q[0] - shift
                for i, x in enumerate(e):
                    if d < 0:
                        break
                    after_q.append(max(d + x, least))
                    after_e.append(x * (q[i + 1] / after_q[-1]))
                    d = d * (q[i + 1] / after_q[-1]) - shift
                if d >= 0 or not shift:
                    break
                shift = 0.0 if shift < eps * (shifted + shift) else shift / 2
            q, e, shifted = [*after_q, max(d, least)], after_e, shifted + shift
        found.append(shifted + q[0])
    return sorted(found, reverse=True)


def twisted(q: np.ndarray, e: np.ndarray, signs: np.ndarray, value: float, others: list[np.ndarray]) -> np.ndarray:
    """Unit eigenvector of B'B to ``value``, orthogonal to ``others``.

    B'B has the diagonal ``q[i] + e[i-1]`` and beside it ``signs[i] * sqrt(q[i] e[i])``.  A factorisation from the top and one from the bottom meet at
    the twist where least is left over; from there the vector follows in both directions.  Where the eigenvalue is close to one before, so that the vector
    leans on ``others``, twisted solves are repeated on what is orthogonal to them.
    """
    n = len(q)
    main = q + np.r_[0.0, e]
    side = signs * np.sqrt(q[:-1] * e)
    tiny = np.finfo(float).eps * max(main.max(), 1e-200) * 1e-3

    def factors(value: float) -> tuple[np.ndarray, np.ndarray, int]:
        top, low = main - value, main - value
        for i in range(n - 1):
            top[i] = top[i] if abs(top[i]) > tiny else tiny
            top[i + 1] -= side[i] ** 2 / top[i]
        for i in range(n - 1, 0, -1):
            low[i] = low[i] if abs(low[i]) > tiny else tiny
            low[i - 1] -= side[i - 1] ** 2 / low[i]
        return top, low, int(np.abs(top + low - (main - value)).argmin())

    top, low, twist = factors(value)

    def solve(rhs: np.ndarray) -> np.ndarray:
        """(B'B - value)^-1 rhs by the factors that meet at the twist."""
        y = rhs.copy()
        for i in range(twist):
            y[i + 1] -= side[i] / top[i] * y[i]
        for i in range(n - 1, twist, -1):
            y[i - 1] -= side[i - 1] / low[i] * y[i]
        left = top[twist] + low[twist] - (main[twist] - value)
        z = np.zeros(n)
        z[twist] = y[twist] / (left if abs(left) > tiny else tiny)
        for i in range(twist - 1, -1, -1):
            z[i] = (y[i] - side[i] * z[i + 1]) / top[i]
        for i in range(twist + 1, n):
            z[i] = (y[i] - side[i - 1] * z[i - 1]) / low[i]
        z /= np.abs(z).max()
        return z / np.linalg.norm(z)

    def apart(z: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for o in others:
                z = z - (o @ z) * o
        return z

    start = np.zeros(n)
    start[twist] = 1.0
    z = solve(start)
    rng = np.random.default_rng(1)
    for _ in range(4):
        alone = apart(z)
        length = np.linalg.norm(alone)
        if length > 0.999:
            return alone / length
        z = solve(alone / length if length > 0.01 else apart(rng.standard_normal(n)))
    alone = apart(z)
    return alone / np.linalg.norm(alone)


def leading(r: np.ndarray, components: int) -> tuple[list[float], np.ndarray, float]:
    """Largest squared singular values of ``r``, their right vectors as columns, and the sum of all squares.

    A cut of the bidiagonal form parts the vectors too: each belongs to the block that has its value."""
    a, b, right = bidiagonalised(r)
    eps = np.finfo(float).eps
    scale = max(np.abs(a).max(), np.abs(b).max(initial=0.0))
    if not scale:
        return [0.0] * min(components, len(a)), np.eye(len(a))[:, :components], 0.0
    cuts = [0, *(np.flatnonzero(np.abs(b) <= eps * eps * scale) + 1), len(a)]
    found = []
    for low, high in zip(cuts, cuts[1:], strict=False):
        q, e = a[low:high] ** 2, b[low : high - 1] ** 2
        found += [(value, low, high) for value in dqds(q.tolist(), e.tolist())]
    found.sort(key=lambda x: -x[0])
    vectors: list[np.ndarray] = []
    for value, low, high in found[:components]:
        q, e = a[low:high] ** 2, b[low : high - 1] ** 2
        signs = np.sign(a[low : high - 1]) * np.sign(b[low : high - 1])
        z = np.zeros(len(a))
        z[low:high] = twisted(q, e, signs, value, [v[low:high] for v in vectors if np.any(v[low:high])])
        vectors.append(z)
    basis = np.array(vectors).T
    for k in range(len(right) - 1, -1, -1):
        u = right[k]
        basis[k + 1 :] -= 2 * np.outer(u, u @ basis[k + 1 :])
    return [v for v, _, _ in found[:components]], basis, sum(v for v, _, _ in found)


def _packed(x: np.ndarray) -> bytes:
    """A vector of whole numbers in the narrowest of three widths, the same bytes for the same vector."""
    width = next(w for w in _WIDTHS if _top(x) <= np.iinfo(w).max or w is np.int64)
    return np.dtype(width).itemsize.to_bytes(1, "little") + x.astype(width).tobytes()


def _vectors(column: pa.Array, dimension: int) -> np.ndarray:
    out = np.empty((len(column), dimension), np.int64)
    for i, data in enumerate(column.to_pylist()):
        out[i] = np.frombuffer(data, np.dtype(f"<i{data[0]}"), offset=1)
    return out


def _top(x: np.ndarray) -> int:
    """The largest absolute value, also where a long cannot hold it."""
    return max(int(x.max()), -int(x.min())) if x.size else 0


def counted(rows: DataFrame, id_column: str, vector: str, *, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``d`` and the packed whole numbers ``x`` of every row with a finite vector; values beyond a long stop at its ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v").cast(pa.large_list(pa.float64()))
            sizes = np.diff(lists.offsets.to_numpy())
            entries = lists.flatten().to_numpy(zero_copy_only=False)
            valid = np.asarray(lists.is_valid())
            sizes = np.where(valid, sizes, 0)
            ends = np.cumsum(sizes)
            bad = np.r_[0, np.cumsum(~np.isfinite(entries))]  # a null entry arrives as nan
            fine = np.flatnonzero(valid & (sizes > 0) & (bad[ends] == bad[ends - sizes]))
            x = np.floor(np.nan_to_num(entries) * scale)
            x = np.where(x >= 2.0**63, _LONG, np.clip(x, -(2.0**63), np.nextafter(2.0**63, 0)).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(fine)), pa.array(sizes[fine], pa.int32()), pa.array([_packed(x[ends[i] - sizes[i] : ends[i]]) for i in fine], pa.binary())],
                names=["vec_id", "d", "x"],
            )

    return mapped(rows.select(rows[id_column].cast("long").alias("vec_id"), rows[vector].cast("array<double>").alias("v")), run, "vec_id long, d int, x binary")


def folded(df: DataFrame, tables: Scratch, name: str, reduce: Callable[[Iterable[pa.Array]], object], combine: Callable[[object, object], object]):
    """One value from all rows of a column: ``reduce`` turns a task's arrays into a state, a tree of tasks combines states.

    Only the last state reaches the driver; None for a table without rows."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = reduce(b.column(0) for b in batches if b.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array([] if state is None else [pickle.dumps(state)], pa.binary())], names=["state"])

    def joined(states: Iterator[bytes]):
        state = None
        for other in map(pickle.loads, states):
            state = other if state is None else combine(state, other)
        return state

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = joined(s.as_py() for b in batches for s in b.column(0))
        yield pa.RecordBatch.from_arrays([pa.array([] if state is None else [pickle.dumps(state)], pa.binary())], names=["state"])

    level = 0
    states = tables.written(mapped(df, first, "state binary"), f"{name}-0")
    while (count := states.count()) > 1:
        level += 1
        states = tables.written(mapped(states.repartition(-(-count // FAN)), again, "state binary"), f"{name}-{level}")
    rows = states.collect()
    tables.drop(*(f"{name}-{i}" for i in range(level + 1)))
    return pickle.loads(rows[0]["state"]) if rows else None


@dataclass(frozen=True)
class Whitening:
    """What whitening needs of the fit list: its size, its sums, and the leading components."""

    n: int
    sums: list[int]
    values: list[float]
    basis: np.ndarray
    trace: float

    def reach(self, x: np.ndarray) -> int:
        """No entry of n x - S is larger."""
        return self.n * _top(x) + max(map(abs, self.sums), default=0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, from whole numbers while they fit."""
        if self.reach(x) < 1 << 62:
            return (x * self.n - np.array(self.sums, np.int64)) / self.n
        return x - np.array([s / self.n for s in self.sums])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2, exact; None where it is beyond a long."""
        if len(self.sums) * self.reach(x) ** 2 <= _LONG:
            return ((x * self.n - np.array(self.sums, np.int64)) ** 2).sum(1).tolist()
        exact = [sum((self.n * int(c) - s) ** 2 for c, s in zip(row, self.sums, strict=True)) for row in x]
        return [v if v <= _LONG else None for v in exact]

    def projected(self, x: np.ndarray) -> np.ndarray:
        """One column per component of a positive eigenvalue."""
        some = [k for k, v in enumerate(self.values) if v > 0]
        return self.centred(x) @ self.basis[:, some] / np.sqrt([self.values[k] for k in some])


def fitted(fit: DataFrame, dimension: int, tables: Scratch, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table of distinct packed vectors ``x``; None without rows.

    An eigenvalue at the level of rounding counts as 0: its component has no whitened value."""

    def sums(arrays):
        n, total = 0, [0] * dimension
        for x in (_vectors(a, dimension) for a in arrays):
            wide = x if _top(x) < 1 << 40 else x.astype(object)
            n, total = n + len(x), [t + int(s) for t, s in zip(total, wide.sum(0), strict=True)]
        return (n, total) if n else None

    whole = folded(fit, tables, "sums", sums, lambda a, b: (a[0] + b[0], [x + y for x, y in zip(a[1], b[1], strict=True)]))
    if whole is None:
        return None
    centre = Whitening(*whole, [], np.zeros((dimension, 0)), 0.0)

    def triangle(arrays):
        r = np.zeros((0, dimension))
        for a in arrays:
            for at in range(0, len(a), BLOCK_ROWS):
                r = np.linalg.qr(np.vstack([r, centre.centred(_vectors(a[at : at + BLOCK_ROWS], dimension))]), mode="r")
        return r if len(r) else None

    r = folded(fit, tables, "triangles", triangle, lambda a, b: np.linalg.qr(np.vstack([a, b]), mode="r"))
    square = np.zeros((dimension, dimension))
    square[: len(r)] = r
    values, basis, total = leading(square, min(components, dimension))
    noise = values[0] * (dimension * np.finfo(float).eps) ** 2 * 100
    return Whitening(whole[0], whole[1], [v / whole[0] if v > noise else 0.0 for v in values], basis, total / whole[0])


def identity_error(fit: DataFrame, model: Whitening, tables: Scratch) -> float:
    """Largest absolute entry of the whitened covariance over the fit list minus the identity, from means and centred products."""
    dimension = len(model.sums)

    def moments(arrays):
        state = None
        for a in arrays:
            w = model.projected(_vectors(a, dimension))
            mean = w.mean(0)
            own = (len(w), mean, (w - mean).T @ (w - mean))
            state = own if state is None else joined(state, own)
        return state

    def joined(a, b):
        n, apart = a[0] + b[0], b[1] - a[1]
        return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)

    n, _, products = folded(fit, tables, "moments", moments, joined)
    return float(np.abs(products / n - np.eye(len(products))).max(initial=0.0))


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error`` for every row with a whole vector.

    Null and empty vectors and those with null or non-finite entries are dropped; so are vectors of another length than the
    commonest (the shorter of two that are as common), which have no place in the covariance.  Repeated rows and null ids keep
    their rows; equal vectors count once in the fit.  Fewer dimensions than ``components`` give fewer rows; a component without variance
    has a null ``whitened`` and explains 0.  A ``deviation`` beyond a long is null.  An empty table gives no row; other columns are ignored.
    """
    spark = rows.sparkSession
    tables = Scratch(spark)
    packed = tables.written(counted(rows, id_column, vector), "vectors")
    common = packed.groupBy("d").count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not common:
        return spark.createDataFrame([], OUT)
    dimension = common[0]["d"]
    kept = packed.filter(F.col("d") == dimension)
    fit = tables.written(kept.select("x").distinct(), "fit")
    model = fitted(fit, dimension, tables, components)
    error = identity_error(fit, model, tables)
    tables.drop("fit")
    shares = [v / model.trace if model.trace else 0.0 for v in model.values]
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column("x"), dimension)
            size = len(x)
            out = np.full((size, k), np.nan)
            some = [j for j, v in enumerate(model.values) if v > 0]
            out[:, some] = model.projected(x)
            at = pa.array(np.repeat(np.arange(size), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1), size), pa.int32()), pa.array(np.full(size * k, model.n), pa.int64()),
                    pa.array(model.deviations(x), pa.int64()).take(at), pa.array(out.ravel(), pa.float64(), mask=np.isnan(out.ravel())),
                    pa.array(np.tile(shares, size), pa.float64()), pa.array(np.full(size * k, error), pa.float64()),
                ],
                names=[c.split()[0] for c in OUT.split(", ")],
            )

    return mapped(kept.select("vec_id", "x"), run, OUT)
