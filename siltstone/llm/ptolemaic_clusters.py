"""Centroid clustering in whole numbers, with lower bounds from Ptolemy's inequality.

Vectors of one length become integers floor(scale * x). Centroids are integers too, so squared
distances, sums and the floors of means are exact and a rerun gives the same clusters.

Pivots are a few of the first centroids and never change. Every vector's distances to them are
computed once and cached next to it. For a pair of pivots p, s Ptolemy's inequality says

    d(x, c) * d(p, s) >= | d(x, p) * d(c, s) - d(x, s) * d(c, p) |

so the pairs bound a vector's distance to a centroid from below by cached numbers alone. The
bound is rounded towards zero by more than its own error. Each vector is compared exactly with
the centroid of the smallest bound, and then with every centroid whose bound does not exceed
that distance: no centroid that could be as near is left out, so ties are seen as well.

A round reads the cached table, sums up per task and brings clusters x components sums to the
driver, whatever the number of vectors. No row moves between tasks.

Rows whose vector is null, of another length, or holds a null or non-finite component take no
part. A component of 2**19 or more in size is not taken either: its squared distances may leave
a long. Of rows with one id each is clustered by itself; a null id stays null (in the order of
the first centroids it counts as empty text, and equal hashes are ordered by the components). With
fewer vectors than clusters there are fewer clusters; of no vectors come no rows. Sums beyond a
long are shown as the largest long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import staged

# Above the error of a bound of double numbers, by a factor of a thousand.
SLACK = 1e-12
# Components below it keep the squared distance of two vectors within a long.
COMPONENT_LIMIT = 1 << 27
LARGEST = (1 << 63) - 1
# Vectors that one step bounds, and pairs of vector and centroid that one step compares.
STEP_VECTORS, STEP_PAIRS = 2048, 1 << 15


@dataclass(frozen=True)
class Pivots:
    """Fixed points, the pairs of them in use, and the distance within each pair."""

    points: np.ndarray
    first: np.ndarray
    second: np.ndarray
    gap: np.ndarray


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of paired rows of integers."""
    d = x - y
    return (d * d).sum(axis=-1)


def choose_pivots(centroids: np.ndarray, most: int) -> Pivots:
    """Centroids far from each other: the first one, then always the one farthest from those
    chosen. All pairs of them are used; equal points are not."""
    chosen, away = [0], squared(centroids, centroids[0])
    while len(chosen) < most and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, squared(centroids, centroids[chosen[-1]]))
    points = centroids[chosen]
    first, second = np.triu_indices(len(points), 1)
    return Pivots(points, first, second, np.sqrt(squared(points[first], points[second])))


def pivot_distances(x: np.ndarray, pivots: Pivots) -> np.ndarray:
    return np.sqrt(np.stack([squared(x, p) for p in pivots.points], axis=1).astype(np.float64))


def lower_bounds(near: np.ndarray, centroid_near: np.ndarray, pivots: Pivots) -> np.ndarray:
    """Vectors x centroids: a number never above the distance, from pivot distances alone."""
    best = np.zeros((len(near), len(centroid_near)))
    for p, s, gap in zip(pivots.first, pivots.second, pivots.gap, strict=True):
        a = near[:, p, None] * centroid_near[None, :, s]
        b = near[:, s, None] * centroid_near[None, :, p]
        np.maximum(best, (np.abs(a - b) - SLACK * (a + b)) * ((1 - SLACK) / gap), out=best)
    return best


def assign(x: np.ndarray, near: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector (the smaller number of ties) and its squared distance."""
    centroid_near = pivot_distances(centroids, pivots)
    owner, best = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for lo in range(0, len(x), STEP_VECTORS):
        part = x[lo : lo + STEP_VECTORS]
        bound = lower_bounds(near[lo : lo + STEP_VECTORS], centroid_near, pivots)
        bound = bound * bound * (1 - SLACK)
        guess = squared(part, centroids[bound.argmin(axis=1)])
        row, centroid = np.nonzero(bound <= guess[:, None].astype(np.float64))
        found = np.full(bound.shape, LARGEST)
        for at in range(0, len(row), STEP_PAIRS):
            r, c = row[at : at + STEP_PAIRS], centroid[at : at + STEP_PAIRS]
            found[r, c] = squared(part[r], centroids[c])
        owner[lo : lo + STEP_VECTORS] = found.argmin(axis=1)
        best[lo : lo + STEP_VECTORS] = found.min(axis=1)
    return owner, best


# -- on Spark ---------------------------------------------------------------------------


def whole_numbers(vector: Column, length: int, scale: int) -> Column:
    """floor(scale * x) of a vector that takes part, else null."""
    limit = F.lit(COMPONENT_LIMIT / scale)
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < limit, F.lit(False)) & ~F.isnan(x.cast("double")))
    parts = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("int"))
    return F.when((F.size(vector) == length) & fine, parts)


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The `k` vectors with the smallest hash of seed and id, in the order of the hash."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    picked = vectors.select(digest.alias("digest"), "v").orderBy("digest", "v").limit(k).collect()
    return np.array([r["v"] for r in picked], np.int64)


def rows_of(column: pa.Array, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1), kind)


def cached(vectors: DataFrame, pivots: Pivots) -> DataFrame:
    """(id, v, near): the vectors with their distances to the pivots."""
    kind = vectors.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = pivot_distances(rows_of(batch.column(1), np.int64), pivots)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(near) + 1, dtype=np.int32) * near.shape[1]), pa.array(near.reshape(-1))
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["id", "v", "near"])

    return vectors.mapInArrow(run, f"id {kind}, v array<int>, near array<double>")


def cluster_sums(rows: DataFrame, centroids: np.ndarray, pivots: Pivots) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and sum of each component, per cluster that has vectors.

    A task gives at most one row per cluster and component; sums of tasks add up as decimals.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), np.int64)
        total = np.zeros(centroids.shape, np.int64)
        for batch in batches:
            x = rows_of(batch.column(0), np.int64)
            owner, _ = assign(x, rows_of(batch.column(1), np.float64), centroids, pivots)
            count += np.bincount(owner, minlength=len(count))
            np.add.at(total, owner, x)
        used = np.flatnonzero(count)
        size = centroids.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, size).astype(np.int32)),
                pa.array(np.tile(np.arange(size, dtype=np.int32), len(used))),
                pa.array(np.repeat(count[used], size)),
                pa.array(total[used].reshape(-1)),
            ],
            names=["cluster", "component", "n", "total"],
        )

    parts = rows.select("v", "near").mapInArrow(run, "cluster int, component int, n long, total long")
    sums = parts.groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(20,0)")).alias("total"))
    out: dict[int, tuple[int, list[int]]] = {}
    # clusters x components rows
    for r in sorted(sums.collect(), key=lambda r: (r["cluster"], r["component"])):
        out.setdefault(r["cluster"], (r["n"], []))[1].append(int(r["total"]))
    return out


def assigned(rows: DataFrame, centroids: np.ndarray, pivots: Pivots) -> DataFrame:
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, best = assign(rows_of(batch.column(1), np.int64), rows_of(batch.column(2), np.float64), centroids, pivots)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(owner.astype(np.int32)), pa.array(best)], names=["id", "cluster", "distance"]
            )

    return rows.select("id", "v", "near").mapInArrow(run, f"id {kind}, cluster int, distance long")


def centroid_digest(centroid: np.ndarray) -> str:
    return sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(
    df: DataFrame,
    id_col: str,
    vector_col: str,
    k: int = 40,
    rounds: int = 5,
    length: int = 64,
    scale: int = 256,
    seed: int = 2,
    pivots: int = 8,
) -> tuple[DataFrame, np.ndarray]:
    """Rows (id, cluster, distance, cluster_inertia, inertia, centroid_sha256), and the centroids.

    `rounds` times every vector goes to its nearest centroid and each centroid with vectors moves
    to the floor of their mean; then vectors are assigned once more.
    """
    vectors = df.select(df[id_col].alias("id"), whole_numbers(df[vector_col], length, scale).alias("v")).where("v is not null")
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        empty = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return vectors.select("id", F.from_json(F.lit("{}"), empty).alias("s")).select("id", "s.*"), centroids
    fixed = choose_pivots(centroids, pivots)
    rows = staged(cached(vectors, fixed), "clusters-cached")
    for _ in range(rounds):
        centroids = centroids.copy()
        for cluster, (n, total) in cluster_sums(rows, centroids, fixed).items():
            centroids[cluster] = [t // n for t in total]
    out = staged(assigned(rows, centroids, fixed), "clusters-assigned")
    # at most k rows
    inertia = {
        r["cluster"]: int(r["d"])
        for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect()
    }
    whole = min(sum(inertia.values()), LARGEST)
    about = out.sparkSession.createDataFrame(
        [(c, min(d, LARGEST), whole, centroid_digest(centroids[c])) for c, d in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return out.join(F.broadcast(about), "cluster").select("id", "cluster", "distance", *about.columns[1:]), centroids
