"""Helpers of the vector operators: rows as matrices, k-means on a bounded sample."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import seeded


def usable(vector: str) -> Column:
    """Whether a vector is not null, has only finite components and is not zero."""
    c = F.col(vector)
    huge = F.lit(1.7e308)
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) <= huge))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & fine & F.exists(c, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """A column of lists of equal length as rows of doubles."""
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def sample(df: DataFrame, vector: str, rows: int, seed: int) -> np.ndarray:
    """At most `rows` vectors, picked by a seeded hash; equal vectors count once."""
    picked = df.select(F.col(vector).cast("array<double>").alias("v")).distinct().orderBy(seeded(seed, F.col("v")), "v").limit(rows)
    got = picked.collect()
    return np.array([r["v"] for r in got], np.float64) if got else np.zeros((0, 0))


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        owner = nearest(x, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, owner, x)
        count = np.bincount(owner, minlength=len(centers))[:, None]
        centers = np.where(count > 0, sums / np.maximum(count, 1), centers)
    return centers


def distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centers."""
    d = (x * x).sum(axis=1)[:, None] - 2 * x @ centers.T + (centers * centers).sum(axis=1)
    return np.maximum(d, 0)


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return distances(x, centers).argmin(axis=1)
