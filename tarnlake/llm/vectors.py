"""Vector columns in tasks: usable rows, matrices, exact integer distances."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scaled components beyond this have squared distances that leave 64 bits.
MAX_COMPONENT = 1 << 27


def finite(v: Column) -> Column:
    """Not null and without null or non-finite components."""
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(whole, F.lit(False))


def usable(v: Column) -> Column:
    """Finite and not zero."""
    return F.coalesce(finite(v) & F.exists(v, lambda x: x != 0), F.lit(False))


def scaled(v: Column, factor: int) -> Column:
    """floor(factor * x) of every component, x as double; null where one is
    beyond ``MAX_COMPONENT``."""
    fits = F.forall(v, lambda x: F.abs(x.cast("double") * factor) < MAX_COMPONENT)
    return F.when(fits, F.transform(v, lambda x: F.floor(x.cast("double") * factor).cast("int")))


def bounded_sample(rows: DataFrame, by_hash: Column, n: int, most: int) -> DataFrame:
    """At most ``most`` of about ``n`` rows, those of least hash within a share
    that holds about twice as many: what tasks send on does not grow with their
    number."""
    share = F.pmod(by_hash, F.lit(max(1, n // (2 * most)))) == 0
    return rows.where(share).orderBy(by_hash).limit(most)


def matrix(col: pa.ChunkedArray | pa.Array, kind: type = np.float64) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(col), -1)


def square_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to integer rows.

    Small components are multiplied as doubles, in which all sums are whole
    numbers below 2**53; others as 64-bit integers.
    """
    top = max(np.abs(x).max(initial=0), np.abs(y).max(initial=0))
    if 4 * int(top) ** 2 * x.shape[1] < 1 << 53:
        a, b = x.astype(np.float64), y.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in y], axis=1) if len(y) else np.zeros((len(x), 0), np.int64)


def row_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distance of each integer row to the row beside it."""
    d = x - y
    return np.einsum("...j,...j->...", d, d)


def take_nearer(best: np.ndarray, who: np.ndarray, rows: np.ndarray, d: np.ndarray, names: np.ndarray) -> None:
    """Keep for each of ``rows`` the nearer entry, of equal ones the lower."""
    better = (d < best[rows]) | ((d == best[rows]) & (names < who[rows]))
    best[rows] = np.where(better, d, best[rows])
    who[rows] = np.where(better, names, who[rows])


#: Relative slack of bounds that are compared in doubles.
SLACK = 1e-12


def floor_root(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64)) * (1 - SLACK)


def ceil_root(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64)) * (1 + SLACK)
