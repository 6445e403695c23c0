"""Shared pieces of the vector operators."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_usable(vector: str | Column) -> Column:
    """True for a vector with a direction: not null, every component finite, not all zero."""
    values = F.col(vector) if isinstance(vector, str) else vector
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(
        (F.size(values) > 0) & F.forall(values, finite) & F.exists(values, lambda x: x != 0),
        F.lit(False),
    )


def usable(df: DataFrame, id_col: str, vector_col: str, *more: str) -> DataFrame:
    """id, dim, vector (doubles) and `more` of the rows that can be compared."""
    return df.where(F.col(id_col).isNotNull() & is_usable(vector_col)).select(
        F.col(id_col).cast("long").alias("id"),
        F.size(vector_col).alias("dim"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        *more,
    )


def widest(rows: DataFrame) -> int:
    """The greatest vector length, 0 without rows."""
    return rows.agg(F.max("dim")).first()[0] or 0


def as_matrix(column: pa.ListArray | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column as a matrix, short ones filled with zeros on the right."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) == len(column) * width:
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def balanced(matrix: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their greatest component to 0.5 up to 1.

    Their cosines stay as they are, to the last bit where nothing was too small or too large to be
    squared; no product overflows or vanishes any more.
    """
    top = np.abs(matrix).max(axis=1, initial=0, keepdims=True)
    return np.ldexp(matrix, -np.frexp(top)[1])


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; by the greatest component first, so that no square overflows."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of the nearest centre of each point."""
    return np.argmin((centres**2).sum(1) - 2 * points @ centres.T, axis=1)


def kmeans(points: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """At most k centres by Lloyd's rounds; an empty centre keeps its place."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest(points, centres)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres
