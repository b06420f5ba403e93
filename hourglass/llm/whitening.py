"""Whitening of embeddings by spectrum slicing.

The covariance of the distinct vectors is summed in the tasks.  Its leading
eigenvalues are found one by one: the inertia of an LDL^T factorisation of
``V - s I`` counts the eigenvalues above ``s``, bisection on these counts
isolates eigenvalue k, Rayleigh quotient iteration converges to it cubically,
and two more counts certify that it is number k.  Only sums, a matrix of
``dimensions**2`` entries, are handled on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.support import materialize

SCALE = 256
COMPONENTS = 4
#: Entries beyond this magnitude leave no exact 64-bit integers; such rows count as non-finite.
LARGEST = 2.0**52
RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


# ---------------------------------------------------------------- spectrum


def inertia(a: np.ndarray) -> tuple[int, int, int]:
    """(positive, negative, zero) eigenvalues of a symmetric matrix, by an
    LDL^T factorisation with Bunch-Kaufman pivots of order 1 and 2."""
    a, alpha = np.array(a, float), (1 + 17**0.5) / 8
    n, k, signs = len(a), 0, [0, 0, 0]

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    def tell(d: float) -> None:
        signs[0 if d > 0 else 1 if d < 0 else 2] += 1

    while k < n:
        column = np.abs(a[k + 1 :, k])
        largest = column.max(initial=0.0)
        if max(abs(a[k, k]), largest) == 0:
            tell(0.0)
            k += 1
            continue
        order = 1
        if abs(a[k, k]) < alpha * largest:
            r = k + 1 + int(column.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0
            if abs(a[k, k]) * row.max() < alpha * largest**2:
                if abs(a[r, r]) >= alpha * row.max():
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    order = 2
        if order == 1:
            d = a[k, k]
            tell(d)
            below = a[k + 1 :, k].copy()
            a[k + 1 :, k + 1 :] -= np.outer(below, below / d)
        else:
            block, below = a[k : k + 2, k : k + 2].copy(), a[k + 2 :, k : k + 2].copy()
            for d in np.linalg.eigvalsh(block):
                tell(float(d))
            a[k + 2 :, k + 2 :] -= below @ np.linalg.solve(block, below.T)
        k += order
    return signs[0], signs[1], signs[2]


def count_above(v: np.ndarray, s: float) -> int:
    """How many eigenvalues of ``v`` are above ``s``."""
    return inertia(v - s * np.eye(len(v)))[0]


def rayleigh(v: np.ndarray, start: np.ndarray, shift: float, before: np.ndarray) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration next to ``shift``, at right angles to the
    vectors found ``before``: two steps of inverse iteration at the shift
    itself, then the quotient as the shift until it stands still."""
    size = np.abs(v).sum(axis=1).max()
    x, value = start, shift
    for step in range(30):
        try:
            y = np.linalg.solve(v - value * np.eye(len(v)), x)
        except np.linalg.LinAlgError:  # the shift is the eigenvalue to the last bit
            y = np.linalg.solve(v - (value + size * 1e-15) * np.eye(len(v)), x)
        for _ in range(2):
            y -= before.T @ (before @ y)
        x = y / np.linalg.norm(y)
        quotient = float(x @ v @ x)
        still = np.linalg.norm(v @ x - quotient * x) <= 4e-16 * size * len(v) ** 0.5
        if step and (still or quotient == value):
            break
        if step:
            value = quotient
    return quotient, x


@dataclass
class Component:
    value: float
    vector: np.ndarray
    certified: bool


def leading(v: np.ndarray, most: int) -> list[Component]:
    """The ``most`` leading eigenpairs of a covariance, those of (numerically)
    zero variance left out."""
    d = len(v)
    size = float(np.abs(v).sum(axis=1).max(initial=0.0))
    found: list[Component] = []
    floor = size * 1e-13
    tests = np.random.default_rng(0).standard_normal((most, d))
    ceiling = size * (1 + 1e-12)
    counts = {ceiling: 0}

    def above(s: float) -> int:
        if s not in counts:
            counts[s] = count_above(v, s)
        return counts[s]

    for k in range(1, min(most, d) + 1):
        if size == 0 or above(floor) < k:
            break
        # Counts of earlier components bound this one too.
        lo = max(s for s, c in counts.items() if c >= k)
        hi = min(s for s, c in counts.items() if c < k)
        before = np.array([c.vector for c in found]).reshape(-1, d)
        while True:
            alone = above(lo) == k and above(hi) == k - 1
            narrow = hi - lo <= 4e-15 * size
            if alone or narrow:
                value, vector = rayleigh(v, tests[k - 1], (lo + hi) / 2, before)
                slack = 1e-14 * size * d**0.5
                if lo - slack <= value <= hi + slack or narrow:
                    break
            middle = (lo + hi) / 2
            lo, hi = (middle, hi) if above(middle) >= k else (lo, middle)
        # Certificate: k - 1 eigenvalues above, k from just below on.
        slack = 1e-12 * size
        certified = above(value + slack) <= k - 1 and above(value - slack) >= k
        found.append(Component(value, vector, certified))
    if not all(c.certified for c in found):
        raise ArithmeticError("the inertia counts do not confirm the numbering of the eigenvalues")
    return found


# ------------------------------------------------------------------- tasks


def vectors(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths, without nulls, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    return np.floor(scale * x.astype(np.float64)).astype(np.int64)


def _summed(rows: DataFrame, width: int, part: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """Sum over all vectors of ``part`` (a matrix per batch): one matrix a task,
    then a sum per matrix row in Spark; only the result comes to the driver."""
    dtype = np.int64 if kind == "long" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(vectors(batch.column(0)))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total))], ["i", "row"])

    def add(table: pa.Table) -> pa.Table:
        row = np.sum(np.array(table.column("row").to_pylist(), dtype), axis=0)
        return pa.table({"i": table.column("i")[:1], "row": pa.array([row])}, schema=pa.schema([("i", pa.int32()), ("row", pa.list_(pa.from_numpy_dtype(dtype)))]))

    schema = f"i int, row array<{kind}>"
    total = rows.mapInArrow(run, schema).groupBy("i").applyInArrow(add, schema).collect()
    return np.array([r.row for r in sorted(total)], dtype).reshape(-1, width)


@dataclass
class Whitening:
    """``n`` distinct vectors, their integer sums and covariance, the leading
    components, and the measured distance of the whitened covariance from 1."""

    n: int
    sums: np.ndarray
    covariance: np.ndarray
    components: list[Component]
    identity_error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values of integer vectors, a column per component."""
        basis = np.array([c.vector / c.value**0.5 for c in self.components]).reshape(-1, len(self.sums))
        return (x - self.sums / self.n) @ basis.T


def usable(rows: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Rows with a vector of finite entries and of the table's dimension: the
    length that most such vectors have (the greater one of a tie)."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    sound = F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < F.lit(LARGEST / SCALE)) & ~F.isnan(c))
    good = rows.where(v.isNotNull() & (F.size(v) > 0) & sound)
    size = good.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    return good.where(F.size(v) == (size.d if size else 0))


def fit_whitening(good: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Sums, covariance and components over the distinct integer vectors of
    ``good`` (see ``usable``); None without rows.

    Equal vectors are combined in the tasks before they meet, so a vector that
    holds a third of all rows costs one row a task.  The covariance is summed
    from vectors moved by the whole number next to the mean, in integers that
    doubles hold exactly, so it does not depend on the order of the sums.
    """
    whole = F.transform(F.col(f"`{vector_col}`").cast("array<double>"), lambda c: F.floor(c * F.lit(float(SCALE))))
    fit = materialize(good.select(whole.alias("x")).groupBy("x").agg(F.lit(1).alias("once")).select("x"), "fit-vectors")
    first = fit.first()
    if first is None:
        return None
    width = len(first.x)
    rows = _summed(fit, width + 1, lambda x: np.append(x.sum(axis=0), len(x))[None, :], "long")[0]
    n, sums = int(rows[-1]), rows[:-1]
    near = np.rint(sums / n).astype(np.int64)
    products = _summed(fit, width, lambda x: (lambda c: c.T @ c)((x - near).astype(np.float64)), "double")
    rest = (sums - n * near) / n
    covariance = products / n - np.outer(rest, rest)
    found = leading((covariance + covariance.T) / 2, components)
    model = Whitening(n, sums, covariance, found, 0.0)
    if found:
        k = len(found)
        # The whitened values of the fit list, measured: sums and products in one pass.
        both = _summed(fit, k, lambda x: (lambda w: np.vstack((w.T @ w, w.sum(axis=0))))(model.project(x)), "double")
        mean = both[k] / n
        model.identity_error = float(np.abs(both[:k] / n - np.outer(mean, mean) - np.eye(k)).max())
    return model


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Exact sums of ``(n x - S)^2`` per row; null where one exceeds 64 bits."""
    bound = (n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0))) ** 2 * x.shape[1]
    if bound < 2**63:
        return pa.array(((n * x - sums) ** 2).sum(axis=1), pa.int64())
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums.tolist(), strict=True)) for row in x.tolist()]
    return pa.array([e if e < 2**63 else None for e in exact], pa.int64())


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: ``vec_id, component, n,
    deviation, whitened, explained, identity_error``.

    Rows whose vector is null, empty, of another length than most, or holds a
    null, non-finite or huge entry (over 2**44) are left out, as are components
    without variance, that is all of them if there is one distinct vector.
    Rows that repeat an id or a vector are returned each; an empty table gives
    no rows; other columns are not read.
    """
    good = usable(rows.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").alias("embedding")))
    model = fit_whitening(good, components=components)
    kind = good.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, {RESULT}"
    if model is None or not model.components:
        return good.sparkSession.createDataFrame([], schema)
    explained = np.array([c.value for c in model.components]) / np.trace(model.covariance)
    k = len(model.components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = integers(vectors(batch.column(1)))
            again = pa.array(np.repeat(np.arange(len(x)), k))
            columns = [
                batch.column(0).take(again), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                pa.array(np.full(len(x) * k, model.n), pa.int64()), deviations(x, model.n, model.sums).take(again),
                pa.array(model.project(x).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", *[f.split()[0] for f in RESULT.split(", ")]])

    return good.mapInArrow(run, schema)
