"""Whitening of embeddings along their leading principal components.

Vectors become whole numbers, so that sums, products and deviations are exact, whatever the order
in which tasks add them up.  The covariance is a table of the dimension squared; its leading
eigenvalues are isolated by counts: the inertia of V - sI, read off an LDL' factorisation, says how
many eigenvalues lie above s.  Inside an interval with one eigenvalue Rayleigh quotient iteration
converges cubically, and two more counts beside the result certify its number.

Rows whose vector is null or holds null or non-finite entries are dropped; all others are fitted
and returned, repeated ones and those without an id too.  A vector shorter than the longest counts
as filled with zeros; empty ones are all zeros.  Entries beyond 2**42 count as
2**42, so that a thousandfold stays a whole double.  A component without variance has null `whitened` values; with no
variance at all `explained` is null.  An empty table gives no rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.vectors import as_matrix
from tidelog.sources.scratch import durable

SCALE, SHIFT, BOUND = 1024, 100_000, 2**52
_EPS = np.finfo(float).eps
_WHOLE = "decimal(38,0)"


# --- eigenvalues of a symmetric matrix -------------------------------------------------------


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """Numbers of positive, zero and negative eigenvalues, from LDL' with pivots of one or two rows."""
    a = np.array(matrix, dtype=float)
    n, at, counts = len(a), 0, [0, 0, 0]
    keep = (1 + 17**0.5) / 8  # bounds the growth of elements
    while at < n:
        rest = a[at:, at:]
        diagonal = np.abs(np.diagonal(rest))
        p = int(np.argmax(diagonal))
        off = np.abs(np.tril(rest, -1))
        r, s = divmod(int(np.argmax(off)), len(rest)) if len(rest) > 1 else (0, 0)
        widest = off[r, s]
        if diagonal[p] == 0 and widest == 0:
            counts[1] += n - at
            break
        if diagonal[p] >= keep * widest:
            _swap(rest, 0, p)
            d = rest[0, 0]
            counts[0 if d > 0 else 2] += 1
            rest[1:, 1:] -= np.outer(rest[1:, 0] / d, rest[1:, 0])
            at += 1
        else:  # such a pair of rows has one eigenvalue on either side of zero
            _swap(rest, 0, s)
            _swap(rest, 1, r)
            counts[0] += 1
            counts[2] += 1
            rest[2:, 2:] -= rest[2:, :2] @ np.linalg.solve(rest[:2, :2], rest[2:, :2].T)
            at += 2
    return counts[0], counts[1], counts[2]


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


def count_above(v: np.ndarray, s: float) -> int:
    """Number of eigenvalues above s."""
    return inertia(v - s * np.eye(len(v)))[0]


def _solve(v: np.ndarray, shift: float, right: np.ndarray, size: float) -> np.ndarray:
    """(V - shift I) x = right; a shift that is an eigenvalue to the last bit is moved a little."""
    step = 0.0
    while True:
        try:
            out = np.linalg.solve(v - (shift + step) * np.eye(len(v)), right)
            if np.isfinite(out).all():
                return out
        except np.linalg.LinAlgError:
            pass
        step = step * 4 or 4 * _EPS * size


def _apart(x: np.ndarray, found: np.ndarray) -> np.ndarray:
    """The part of x orthogonal to the found unit columns, as a unit vector."""
    for _ in range(2):
        x = x - found @ (found.T @ x)
    return x / np.linalg.norm(x)


def leading_eigenpairs(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest eigenvalues of a positive semidefinite matrix, falling, and unit vectors as columns.

    Number i is certified: i eigenvalues lie above value - tol and fewer than i above value + tol.
    Eigenvalues closer than rounding allows to tell apart share an interval; their vectors are any
    orthonormal basis of their space.
    """
    n = len(v)
    k = min(k, n)
    size = float(np.abs(v).sum(axis=1).max()) if n else 0.0
    values, vectors = np.zeros(k), np.zeros((n, k))
    if size == 0:
        return values, np.eye(n)[:, :k]
    rng = np.random.default_rng(20_250_101)
    tol = 8 * n * _EPS * size
    known = {-tol: n, size * (1 + 4 * _EPS) + tol: 0}  # shift: eigenvalues above it
    i = 0
    while i < k:
        low = max(s for s, c in known.items() if c > i)
        high = min(s for s, c in known.items() if c <= i)
        while known[low] - known[high] > 1 and high - low > 2 * tol:
            low, high = _halve(v, known, low, high, i)
        inside = known[low] - known[high]
        if inside > 1:
            start = rng.standard_normal((n, inside))
            for _ in range(3):
                start -= vectors[:, :i] @ (vectors[:, :i].T @ start)
                start = np.linalg.qr(_solve(v, (low + high) / 2, start, size))[0]
            start -= vectors[:, :i] @ (vectors[:, :i].T @ start)
            start = np.linalg.qr(start)[0]
            for j in range(min(inside, k - i)):
                vectors[:, i + j] = start[:, j]
                values[i + j] = max(start[:, j] @ v @ start[:, j], 0.0)
            i += inside
            continue
        found = None
        while found is None:
            found = _rayleigh(v, low, high, vectors[:, :i], rng, size)
            if found is not None:
                value = found @ v @ found
                for s in (value - tol, value + tol):
                    known[s] = count_above(v, s)
                if known[value - tol] <= i or known[value + tol] > i:
                    found = None  # it is another one's: closer in
            if found is None:
                if high - low <= 2 * tol:
                    raise ArithmeticError("an isolated eigenvalue did not converge")
                low, high = _halve(v, known, low, high, i)
        values[i], vectors[:, i] = max(value, 0.0), found
        i += 1
    return values, vectors


def _halve(v: np.ndarray, known: dict, low: float, high: float, i: int) -> tuple[float, float]:
    """The half of the interval that holds eigenvalue number i (from 0)."""
    middle = (low + high) / 2
    known[middle] = count_above(v, middle)
    return (middle, high) if known[middle] > i else (low, middle)


def _rayleigh(v, low: float, high: float, found: np.ndarray, rng, size: float) -> np.ndarray | None:
    """The eigenvector of the one eigenvalue in the interval, or None if the iteration leaves it."""
    x = _apart(rng.standard_normal(len(v)), found)
    for _ in range(2):  # inverse iteration from the middle picks the near one
        x = _apart(_solve(v, (low + high) / 2, x, size), found)
    for _ in range(12):
        shift = x @ v @ x
        if not low <= shift <= high:
            return None
        if np.linalg.norm(v @ x - shift * x) <= 2 * _EPS * size:
            break
        x = _apart(_solve(v, shift, x, size), found)
    return x if low <= x @ v @ x <= high else None


# --- exact moments over the table ------------------------------------------------------------


def _usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vectors.where(F.col(vector_col).isNotNull() & F.forall(F.col(vector_col), finite))


def _whole(column: pa.ListArray, width: int) -> np.ndarray:
    """Entries as whole numbers, one row per vector."""
    scaled = np.floor(as_matrix(column, width) * SCALE)
    return np.clip(scaled, -BOUND, BOUND).astype(np.int64) + SHIFT


def _gram(y: np.ndarray) -> np.ndarray:
    """y'y, exactly, as Python numbers."""
    most = int(np.abs(y).max(initial=0))
    if most * most * max(len(y), 1) < 2**53:  # every partial sum is a whole double
        return np.rint(y.T.astype(float) @ y).astype(np.int64).astype(object)
    total = np.zeros((y.shape[1],) * 2, object)
    for lo in range(0, len(y), 256):
        high, low = np.divmod(y[lo : lo + 256], 2**27)
        mixed = (high.T @ low).astype(object)
        total += (high.T @ high).astype(object) * 2**54 + (mixed + mixed.T) * 2**27 + (low.T @ low).astype(object)
    return total


def _decimals(numbers) -> list:
    return [Decimal(int(x)) for x in numbers]


@dataclass
class Moments:
    """Number of vectors, sums by dimension, and the covariance with divisor n."""

    n: int
    sums: list[int]
    covariance: np.ndarray

    @property
    def centre(self) -> np.ndarray:
        """The whole number nearest to each mean, from below."""
        return np.array([s // self.n for s in self.sums], dtype=np.int64)


def moments(vectors: DataFrame, vector_col: str = "embedding") -> Moments:
    """Exact n and sums, then the covariance of the centred values.

    Two passes over the table; each task sends one number per dimension, then one row per
    dimension, and sums are worked out by Spark.  Only dimension squared figures reach the driver.
    """
    rows = _usable(vectors, vector_col).select(F.col(vector_col).cast("array<double>").alias("vector"))
    width = rows.agg(F.max(F.size("vector"))).first()[0]
    if not width:
        return Moments(rows.count() if width == 0 else 0, [], np.zeros((0, 0)))

    def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            x = _whole(batch.column(0), width)
            n += len(x)
            total += x.astype(object).sum(axis=0) if np.abs(x).max(initial=0) > 2**40 else x.sum(axis=0)
        yield _listed([0], [n], [total])

    def grams_of(centre: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((width, width), object)
            for batch in batches:
                total += _gram(_whole(batch.column(0), width) - centre)
            yield _listed(range(width), [0] * width, total)

        return run

    first = _summed(rows.mapInArrow(sums_of, _LISTED)).collect()
    n, sums = int(first[0]["n"]), [int(r["total"]) for r in first]
    found = Moments(n, sums, np.zeros((width, width)))
    gram = np.zeros((width, width), object)
    for r in _summed(rows.mapInArrow(grams_of(found.centre), _LISTED)).collect():
        gram[r["row"], r["place"]] = int(r["total"])
    # What is left of the mean beside the whole-number centre, exactly.
    left = [s - n * int(c) for s, c in zip(sums, found.centre, strict=True)]
    for i in range(width):
        for j in range(i + 1):
            exact = Fraction(n * gram[i, j] - left[i] * left[j], n * n)
            found.covariance[i, j] = found.covariance[j, i] = float(exact)
    return found


_LISTED = f"row int, n long, items array<{_WHOLE}>"


def _listed(rows, n, items) -> pa.RecordBatch:
    kind = pa.list_(pa.decimal128(38, 0))
    lists = pa.array([_decimals(x) for x in items], kind)
    return pa.RecordBatch.from_arrays(
        [pa.array(rows, pa.int32()), pa.array(n, pa.int64()), lists], names=["row", "n", "items"]
    )


def _summed(parts: DataFrame) -> DataFrame:
    """row, place, total, n: the lists of all tasks added up item by item."""
    items = parts.select("row", "n", F.posexplode("items").alias("place", "item"))
    summed = items.groupBy("row", "place").agg(
        F.sum("item").cast(_WHOLE).alias("total"), F.sum("n").alias("n")
    )
    return summed.orderBy("row", "place")


# --- the operator ----------------------------------------------------------------------------


@dataclass
class Whitener:
    """Fitted centre, components as columns, their eigenvalues and the trace of the covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def width(self) -> int:
        return len(self.sums)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates; not a number along a component without variance."""
        centre = np.array([s // self.n for s in self.sums], dtype=np.int64)
        left = np.array([(s - self.n * int(c)) / self.n for s, c in zip(self.sums, centre, strict=True)])
        with np.errstate(divide="ignore", invalid="ignore"):
            out = ((x - centre) - left) @ self.components / np.sqrt(self.eigenvalues)
        out[:, ~self.varied] = np.nan
        return out

    @property
    def varied(self) -> np.ndarray:
        """Components that have variance beyond rounding."""
        return self.eigenvalues > 8 * max(self.width, 1) * _EPS * self.trace

    def deviation(self, x: np.ndarray) -> list:
        """Sum over dimensions of (n x - S)**2, exactly; null beyond 38 digits."""
        centre = np.array([s // self.n for s in self.sums], dtype=np.int64)
        left = [s - self.n * int(c) for s, c in zip(self.sums, centre, strict=True)]
        y = x - centre
        most = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, left), default=0)
        if most * most * max(self.width, 1) < 2**63:
            z = self.n * y - np.array(left, np.int64)
            return _decimals((z * z).sum(axis=1))
        z = y.astype(object) * self.n - np.array(left, object)
        totals = (z * z).sum(axis=1)
        return [Decimal(int(t)) if t < 10**38 else None for t in totals]


def fit(vectors: DataFrame, components: int = 8, vector_col: str = "embedding") -> Whitener:
    """Moments over all vectors, then the leading components of their covariance."""
    seen = moments(vectors, vector_col)
    values, columns = leading_eigenpairs(seen.covariance, components)
    return Whitener(seen.n, seen.sums, columns, values, float(np.trace(seen.covariance)))


def transform(
    vectors: DataFrame, model: Whitener, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """id, `deviation` (decimal) and `whitened` (one number per component) of every usable vector."""
    rows = _usable(vectors, vector_col).select(
        id_col, F.col(vector_col).cast("array<double>").alias("__vector")
    )
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _whole(batch.column(1), shared.value.width)
            out = shared.value.project(x)
            flat = pa.array(out.reshape(-1), from_pandas=True)
            ends = pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(shared.value.deviation(x), pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(ends, flat),
                ],
                names=[id_col, "deviation", "whitened"],
            )

    schema = T.StructType(
        [
            rows.schema[id_col],
            T.StructField("deviation", T.DecimalType(38, 0)),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
        ]
    )
    return rows.mapInArrow(run, schema)


def identity_error(whitened: DataFrame, width: int, column: str = "whitened") -> float | None:
    """Largest absolute entry of the covariance of the whitened values minus the identity.

    Measured on the rows themselves: tasks centre their values and send count, mean and products,
    which are merged about the mean of all.  Components without variance are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, product = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            z = as_matrix(batch.column(0), width)
            if not len(z):
                continue
            own = z.mean(axis=0)
            y, gap, both = z - own, own - mean, n + len(z)
            product += y.T @ y + np.outer(gap, gap) * (n * len(z) / both)
            mean, n = mean + gap * (len(z) / both), both
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n]), pa.array([mean]), pa.array([product.reshape(-1)])],
                names=["n", "mean", "product"],
            )

    filled = F.transform(F.col(column), lambda x: F.coalesce(x, F.lit(0.0)))
    parts = whitened.select(filled.alias("z")).mapInArrow(run, "n long, mean array<double>, product array<double>")
    parts = durable(parts)  # one short row per task
    means = parts.select("n", F.posexplode("mean").alias("place", "item")).groupBy("place")
    centre = {r["place"]: r["item"] for r in means.agg((F.sum(F.col("n") * F.col("item")) / F.sum("n")).alias("item")).collect()}
    if not centre:
        return None
    row, col = F.floor(F.col("place") / width).cast("int"), F.col("place") % width
    at = F.array(*[F.lit(float(centre[i])) for i in range(width)])
    gap = lambda i: F.get("mean", i) - F.get(at, i)
    products = parts.select("n", "mean", F.posexplode("product").alias("place", "item")).select(
        "n", "place", (F.col("item") + F.col("n") * gap(row) * gap(col)).alias("item")
    )
    entries = products.groupBy("place").agg((F.sum("item") / F.sum("n")).alias("item")).collect()
    cov = np.zeros((width, width))
    for r in entries:
        cov[divmod(r["place"], width)] = r["item"]
    used = np.flatnonzero(np.diagonal(cov) != 0)
    if not len(used):
        return None
    return float(np.abs(cov[np.ix_(used, used)] - np.eye(len(used))).max())


def whiten(
    vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per usable vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    model = fit(vectors, components, vector_col)
    wide = transform(vectors, model, id_col, vector_col)
    k = len(model.eigenvalues)
    error = identity_error(wide, k) if k else None
    shares = [float(e / model.trace) if model.trace > 0 else None for e in model.eigenvalues]
    explained = F.array(*[F.lit(s) for s in shares]).cast("array<double>")
    return wide.select(id_col, "deviation", F.posexplode("whitened").alias("__place", "whitened")).select(
        id_col,
        (F.col("__place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("__place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
