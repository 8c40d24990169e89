"""What both vector operators use: usable vectors, a bounded sample, k-means."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(column: str) -> F.Column:
    """Not null, without null or non-finite components, and not zero."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(column).isNotNull() & fine & F.exists(column, lambda x: x != 0), F.lit(False))


def lengths(vectors: DataFrame, column: str) -> list[int]:
    """The lengths that two or more vectors have; only vectors of one length can be compared."""
    n = vectors.groupBy(F.size(column).alias("k")).agg(F.count("*").alias("n")).filter("n > 1")
    return sorted(r["k"] for r in n.collect())  # one row per length


def sample(vectors: DataFrame, key: str, column: str, size: int, seed: int) -> np.ndarray:
    """At most ``size`` vectors, chosen by a hash of ``key`` (bounded: they go to the driver)."""
    rows = vectors.select(key, column).orderBy(F.xxhash64(F.lit(seed), key), key).limit(size).collect()
    return np.array([r[1] for r in rows], np.float64)


def matrix(col: pa.Array) -> np.ndarray:
    """A list column without nulls as a matrix."""
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # first, so that squares do not vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def square_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1), 0)


def kmeans(x: np.ndarray, k: int, rounds: int, g: np.random.Generator) -> np.ndarray:
    """Centres of at most ``k`` clusters; empty ones are dropped."""
    centres = x[g.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = square_distances(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres = sums[n > 0] / n[n > 0, None]
    return centres
