"""Whitening of embedding vectors: exact moments on Spark, leading eigenpairs by spectrum slicing.

The covariance is a small matrix, whatever the number of vectors. The inertia of a shifted covariance (signs of D in its LDLᵀ factors) counts the
eigenvalues above the shift: bisection by these counts isolates each leading eigenvalue, Rayleigh quotient iteration converges to its pair, and
two more counts certify its number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.llm.common import read_columns, stored

SCALE, SHIFT = 64, 1_000_000  # a component c becomes floor(SCALE * c) + SHIFT
COMPONENTS = 16
ROWS_AT_ONCE = 4096
EXACT = 1 << 53  # doubles hold all integers up to here

# --- spectrum slicing --------------------------------------------------------------------------


def inertia(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of a symmetric matrix above ``shift``: positive signs of D in LDLᵀ of the shifted matrix.

    Symmetric pivoting (a diagonal entry, or a block of two rows where the diagonal is too small) keeps the factors bounded.
    """
    a = matrix - shift * np.eye(len(matrix))
    bound, n, above, at = (1 + 17**0.5) / 8, len(matrix), 0, 0

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j], at:] = a[[j, i], at:]
            a[at:, [i, j]] = a[at:, [j, i]]

    while at < n:
        column = np.abs(a[at + 1 :, at])
        largest = column.max(initial=0.0)
        width = 1
        if largest > 0 and abs(a[at, at]) < bound * largest:
            r = at + 1 + int(column.argmax())
            row = np.abs(a[r, at:])
            row[r - at] = 0
            across = row.max()
            if abs(a[at, at]) * across >= bound * largest * largest:
                pass
            elif abs(a[r, r]) >= bound * across:
                swap(at, r)
            else:
                swap(at + 1, r)
                width = 2
        if width == 1:
            pivot = a[at, at]
            above += pivot > 0
            if pivot != 0 and at + 1 < n:
                rest = a[at + 1 :, at].copy()
                a[at + 1 :, at + 1 :] -= np.outer(rest, rest / pivot)
        else:
            block = a[at : at + 2, at : at + 2]
            above += 1  # such a block has one positive and one negative eigenvalue
            if at + 2 < n:
                rest = a[at + 2 :, at : at + 2].copy()
                a[at + 2 :, at + 2 :] -= rest @ np.linalg.solve(block, rest.T)
        at += width
    return int(above)


@dataclass(frozen=True)
class EigenPair:
    """An eigenvalue with its unit vector; its number among falling eigenvalues lies in ``first..last`` (equal ones share a range)."""

    value: float
    vector: np.ndarray
    first: int
    last: int


class SpectrumSlicer:
    """Leading eigenpairs of a symmetric positive semidefinite matrix."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.top = float(np.abs(matrix).sum(axis=1).max()) if len(matrix) else 0.0  # no eigenvalue lies beyond the largest row sum
        self.tiny = self.top * len(matrix) * np.finfo(float).eps  # nearer ones cannot be told apart
        # Counts at the shifts tried so far, shared by all components.
        self.shifts: list[float] = [-self.top - self.tiny, self.top + self.tiny]
        self.counts: list[int] = [len(matrix), 0]

    def above(self, shift: float) -> int:
        if shift in self.shifts:
            return self.counts[self.shifts.index(shift)]
        count = inertia(self.matrix, shift)
        at = int(np.searchsorted(self.shifts, shift))
        self.shifts.insert(at, shift)
        self.counts.insert(at, count)
        return count

    def isolate(self, number: int) -> tuple[float, float]:
        """An interval that holds eigenvalue ``number`` and, unless it is as narrow as rounding allows, no other."""
        while True:
            low = max(i for i, c in enumerate(self.counts) if c >= number)
            a, b = self.shifts[low], self.shifts[low + 1]
            if b - a <= 4 * self.tiny or (self.counts[low] == number and self.counts[low + 1] == number - 1 and b - a <= 1e-3 * max(abs(a), abs(b))):
                return a, b
            self.above((a + b) / 2)

    def pair(self, number: int, found: list[EigenPair]) -> EigenPair:
        """Eigenpair ``number``: Rayleigh quotient iteration inside its interval, orthogonal to the pairs before it."""
        while True:
            a, b = self.isolate(number)
            value, vector = self._iterate((a + b) / 2, number, found)
            slack = 4 * self.tiny
            if a - slack <= value <= b + slack or b - a <= 4 * self.tiny:
                break
            self.above((a + b) / 2)  # it ran to a neighbour: start from a narrower interval
        # Above value + slack lie fewer than number eigenvalues, above value - slack at least number.
        first, last = self.above(value + slack) + 1, self.above(value - slack)
        if not first <= number <= last:
            raise ArithmeticError(f"eigenvalue {value} is number {first} to {last}, not {number}")
        return EigenPair(value, vector, first, last)

    def _solve(self, shift: float, x: np.ndarray) -> np.ndarray:
        for slack in (0, 1, 4, 16, 64):  # a shift may be an eigenvalue to the last bit
            try:
                return np.linalg.solve(self.matrix - (shift + slack * self.tiny) * np.eye(len(x)), x)
            except np.linalg.LinAlgError:
                continue
        raise ArithmeticError(f"no solution near {shift}")

    def _iterate(self, shift: float, number: int, found: list[EigenPair]) -> tuple[float, np.ndarray]:
        n = len(self.matrix)
        known = np.array([p.vector for p in found]).reshape(len(found), n)

        def clean(x: np.ndarray) -> np.ndarray:
            for _ in range(2):  # twice is enough
                x = x - known.T @ (known @ x)
                x = x / np.linalg.norm(x)
            return x

        x = clean(np.random.default_rng(number).standard_normal(n))
        best, least = (shift, x), np.inf
        for step in range(40):
            y = self._solve(shift, x)
            if not np.isfinite(y).all() or not y.any():
                break
            x = clean(y / np.abs(y).max())
            value = float(x @ self.matrix @ x)
            left = float(np.linalg.norm(self.matrix @ x - value * x))
            if left < least:
                best, least = (value, x), left
            elif step > 3:
                break  # rounding only
            if step >= 1:  # one step at the middle of the interval first
                shift = value
        return best


def leading_pairs(matrix: np.ndarray, wanted: int) -> list[EigenPair]:
    """Up to ``wanted`` eigenpairs by falling eigenvalue; those that are zero but for rounding are left out. The largest entry of a vector is positive."""
    slicer, pairs = SpectrumSlicer(matrix), []
    if not slicer.top:
        return []
    for number in range(1, min(wanted, len(matrix)) + 1):
        if slicer.above(16 * slicer.tiny) < number:
            break
        pair = slicer.pair(number, pairs)
        v = pair.vector * np.sign(pair.vector[np.abs(pair.vector).argmax()])
        pairs.append(EigenPair(pair.value, v, pair.first, pair.last))
    return pairs


# --- moments on Spark ----------------------------------------------------------------------------


def scaled_vectors(embeddings: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``(vec_id, x)`` of the usable rows: components times 64, rounded down, plus 1000000, as longs; shorter vectors are filled up with zeros.

    Vectors that are null or hold null or non-finite entries are left out. Values beyond the range of long end at its limits.
    """
    vectors = read_columns(embeddings, id_column, column).toDF("vec_id", "v")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    vectors = vectors.where(F.col("v").isNotNull() & ~bad).select("vec_id", F.col("v").cast("array<double>").alias("v"))
    dim = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    limit = float(1 << 62)

    def scaled(c):
        return F.floor(F.greatest(F.least(c * SCALE, F.lit(limit)), F.lit(-limit))).cast("long") + SHIFT

    x = F.transform("v", scaled)
    full = F.concat(x, F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(dim) - F.size("v")))
    return vectors.select("vec_id", full.alias("x"))


def _rows(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count and exact sums of the vectors of a task, as text: sums may exceed a long."""
    n, sums = 0, None
    for batch in batches:
        if not len(batch):
            continue
        x = _rows(batch.column(0), len(batch.column(0)[0]))
        high = x >> 31  # halves, so that sums of a batch stay within longs
        part = [(int(h) << 31) + int(low) for h, low in zip(high.sum(axis=0), (x - (high << 31)).sum(axis=0), strict=True)]
        n, sums = n + len(x), part if sums is None else [a + b for a, b in zip(sums, part, strict=True)]
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n] * len(sums), pa.int64()), pa.array(range(len(sums)), pa.int32()), pa.array(map(str, sums))], ["n", "i", "s"])


def _products(dim: int, centre: list[int]):
    """Per task: exact sums of y yᵀ, y = x - centre, one row per matrix row."""
    middle = np.array(centre, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim), dtype=object)
        seen = False
        for batch in batches:
            x = _rows(batch.column(0), dim)
            for at in range(0, len(x), ROWS_AT_ONCE):
                seen = True
                total += exact_gram(x[at : at + ROWS_AT_ONCE], middle)
        if seen:
            rows = [[str(int(v)) for v in row] for row in total]
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(rows, pa.list_(pa.string()))], ["i", "q"])

    return run


def exact_gram(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact sums of y yᵀ for rows y = x - centre, as Python integers: by doubles while these hold every sum, else by integers of any size."""
    y = x.astype(object) - centre
    largest = max(abs(int(y.max())), abs(int(y.min()))) if y.size else 0
    if largest * largest * len(y) < EXACT:
        y = y.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    return y.T @ y


def _unscaled(decimals: list) -> list[int]:
    return [int(v) for v in decimals]


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives: its size and sums, eigenvalues and unit vectors (rows) of its covariance, and the trace."""

    n: int
    sums: list[int]
    values: list[float]
    vectors: np.ndarray
    trace: float
    certified: list[tuple[int, int]]  # numbers that the counts allow each component


def moments(fit: DataFrame, dim: int) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, covariance) of distinct ``x`` vectors. All sums are exact, so the result does not depend on how rows are dealt to tasks."""
    totals = fit.select("x").mapInArrow(_totals, "n long, i int, s string")
    rows = totals.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()  # one row per dimension
    if not rows:
        return 0, [], np.zeros((dim, dim))
    n, sums = rows[0].n, _unscaled([r.s for r in rows])
    centre = [s // n for s in sums]
    parts = fit.select("x").mapInArrow(_products(dim, centre), "i int, q array<string>")
    cells = parts.select("i", F.posexplode("q").alias("j", "q")).groupBy("i", "j").agg(F.sum(F.col("q").cast("decimal(38,0)")).alias("q"))
    gram = np.zeros((dim, dim), dtype=object)
    for r in cells.collect():  # one row per matrix entry
        gram[r.i, r.j] = int(r.q)
    left = [s - n * c for s, c in zip(sums, centre, strict=True)]  # sums of y: below n each
    covariance = np.array([[float(Fraction(n * gram[i, j] - left[i] * left[j], n * n)) for j in range(dim)] for i in range(dim)]).reshape(dim, dim)
    return n, sums, covariance


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Whitening of the distinct vectors ``x``. The driver sees sums per dimension and per pair of dimensions, never rows."""
    first = fit.select(F.size("x").alias("d")).first()
    dim = first.d if first else 0
    n, sums, covariance = moments(fit, dim)
    pairs = leading_pairs(covariance, components) if n else []
    vectors = np.array([p.vector for p in pairs]).reshape(len(pairs), dim)
    return Whitening(n, sums, [p.value for p in pairs], vectors, float(np.trace(covariance)), [(p.first, p.last) for p in pairs])


def project(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened rows: (x - S/n) on every component, over the root of its eigenvalue."""
    centre = np.array([s // model.n for s in model.sums], dtype=np.int64)
    rest = np.array([(s % model.n) / model.n for s in model.sums])
    centred = (x - centre).astype(np.float64) - rest
    return centred @ model.vectors.T / np.sqrt(model.values)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums over dimensions of (n*x - S)²; null beyond the range of long."""
    largest = max((abs(int(v)) for v in (x.max(initial=0), x.min(initial=0), *sums)), default=0)
    if max(n, 1) * largest < 1 << 61:
        d = n * x - np.array(sums, dtype=np.int64)
        widest = int(np.abs(d).max(initial=0))
        if widest * widest * max(x.shape[1], 1) < 1 << 62:
            return (d * d).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, dtype=object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, from one more pass over the list."""
    k, dim = len(model.values), len(model.sums)
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Row k has the sums, so that the mean is taken off whatever it is.
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = project(_rows(batch.column(0), dim), model)
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(k + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "q"])

    parts = fit.select("x").mapInArrow(run, "i int, q array<double>")
    sums = np.zeros((k + 1, k))
    for r in parts.select("i", F.posexplode("q").alias("j", "q")).groupBy("i", "j").agg(F.sum("q").alias("q")).collect():  # one row per pair of components
        sums[r.i, r.j] = r.q
    mean = sums[k] / model.n
    return float(np.abs(sums[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Every usable vector on up to ``components`` leading components of the covariance, whitened.

    ``(vec_id, component, n, deviation, whitened, explained, identity_error)``, one row per vector and component. The covariance is that of the
    fit list, which holds each distinct scaled vector once. Copies cost nothing in it and are whitened like all rows, repeated ones too.

    Rows whose vector is null or holds null or non-finite entries are left out; shorter vectors count as filled up with zeros; null ids are kept;
    other columns are not read. Components of eigenvalue zero (constant dimensions, fewer distinct vectors than dimensions) cannot be whitened and are left out, so
    a table without two different vectors, or an empty one, gives no rows. A deviation beyond the range of long is null.
    """
    rows = scaled_vectors(embeddings)
    kind = rows.schema["vec_id"].dataType.simpleString()
    fit = stored(rows.select("x").distinct(), "fit-list")
    model = fit_whitening(fit, components)
    error, k = identity_error(fit, model), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not k or not len(batch):
                continue
            x = _rows(batch.column(1), len(model.sums))
            owner = np.repeat(np.arange(len(x)), k)
            numbers = np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))
            explained = np.tile(np.array(model.values) / model.trace, len(x))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner)), pa.array(numbers), pa.array(np.full(len(owner), model.n)),
                    pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(owner)), pa.array(project(x, model).ravel()), pa.array(explained),
                    pa.array(np.full(len(owner), error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.mapInArrow(run, schema)
