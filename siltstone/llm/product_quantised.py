"""Embedding near-dedup by product quantisation.

Vectors are scaled to length one. A coarse k-means has inverted lists; a vector is stored in
the list of its nearest center with the codes of its residual, one per subspace. A query
probes lists, reads a table of distances per subspace instead of vectors (asymmetric
distances), and what is near enough by the table is checked by its exact cosine.

Nothing above the threshold is lost. Two unit vectors with cosine >= t are at most
r = sqrt(2 - 2t) apart. A neighbour sits in another list only if the bisector of the two
centers is within r of the query, so exactly these lists are probed; and a code's own
quantisation error, stored with it, widens the table's distance before it is compared.

Centers and codebooks are fitted on a bounded sample; every vector is indexed. Equal vectors
of one label are one class with a count. Lists are cut into blocks of bounded size, and a
task compares one block of queries with one block of a list; it returns counts and a spanning
set of links per block, never all pairs.

Vectors that are null, empty, zero or hold null or non-finite components, and those without a
label, have no links. Vectors of different lengths are compared only with their like.
Repeated ids are different rows of equal id: each counts. An empty table gives no rows; extra
columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import connected_components, staged
from siltstone.llm.vectors import distances, kmeans, matrix, nearest, sample, usable

THRESHOLD = 0.98
SAMPLE_ROWS, SUBSPACES, CODES = 2000, 8, 32
BLOCK_ROWS = 2048


class Quantiser:
    """Coarse centers and codebooks of residuals, for vectors of one length."""

    def __init__(self, x: np.ndarray, lists: int, subspaces: int, codes: int) -> None:
        self.centers = kmeans(x, lists)
        residual = x - self.centers[nearest(x, self.centers)]
        self.parts = np.array_split(np.arange(x.shape[1]), min(subspaces, x.shape[1]))
        self.books = [kmeans(residual[:, p], codes, seed=9 + i) for i, p in enumerate(self.parts)]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and quantisation error of each row."""
        owner = nearest(x, self.centers)
        residual = x - self.centers[owner]
        codes = np.stack([nearest(residual[:, p], b) for p, b in zip(self.parts, self.books, strict=True)], axis=1)
        decoded = np.hstack([b[codes[:, i]] for i, b in enumerate(self.books)])
        return owner, codes.astype(np.uint8), np.sqrt(((residual - decoded) ** 2).sum(axis=1))

    def probes(self, x: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, list) such that every neighbour within `radius` is in a probed list."""
        d = distances(x, self.centers)
        own = d.argmin(axis=1)
        apart = np.sqrt(distances(self.centers, self.centers))[own]
        # distance to the bisector between the own center and another one
        bisector = (d - d[np.arange(len(x)), own][:, None]) / np.maximum(2 * apart, 1e-12)
        near = bisector <= radius + 1e-9
        near[np.arange(len(x)), own] = True
        return np.nonzero(near)

    def table_distances(self, x: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Distances of queries to coded vectors of one list, by table lookup."""
        residual = x - self.centers[which]
        total = np.zeros((len(x), len(codes)))
        for i, (p, book) in enumerate(zip(self.parts, self.books, strict=True)):
            total += distances(residual[:, p], book)[:, codes[:, i]]
        return np.sqrt(total)


def block_links(q: Quantiser, queries: pd.DataFrame, stored: pd.DataFrame, threshold: float, radius: float) -> pd.DataFrame:
    """Within one block of queries and one of a list: per class, linked vectors and the
    smallest class it is connected with here."""
    x, y = np.stack(queries["unit"]), np.stack(stored["unit"])
    codes = np.frombuffer(b"".join(stored["codes"]), np.uint8).reshape(len(stored), -1)
    near = q.table_distances(x, int(stored["list"].iloc[0]), codes) <= radius + stored["error"].to_numpy() + 1e-9
    a, b = np.nonzero(near)
    a_id, b_id = queries["cls"].to_numpy(), stored["cls"].to_numpy()
    other = a_id[a] != b_id[b]
    a, b = a[other], b[other]
    cosine = np.concatenate([np.zeros(0), *((x[a[i : i + 4096]] * y[b[i : i + 4096]]).sum(axis=1) for i in range(0, len(a), 4096))])
    linked = cosine >= threshold
    a, b = a[linked], b[linked]
    rows = np.unique(a)
    count = np.bincount(a, weights=stored["n"].to_numpy()[b], minlength=len(x)).astype(np.int64)
    # labels of the block's own graph: smallest class reachable
    left, right = a_id.copy(), b_id.copy()
    while True:
        before = left.copy(), right.copy()
        np.minimum.at(left, a, right[b])
        np.minimum.at(right, b, left[a])
        if (before[0] == left).all() and (before[1] == right).all():
            break
    hit = np.unique(b)
    return pd.DataFrame(
        {
            "cls": np.concatenate([a_id[rows], b_id[hit]]),
            "n": np.concatenate([count[rows], np.zeros(len(hit), np.int64)]),
            "root": np.concatenate([left[rows], right[hit]]),
        }
    )


def near_links(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    sample_rows: int = SAMPLE_ROWS,
    subspaces: int = SUBSPACES,
    codes: int = CODES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per row: id, n_links (other rows linked directly), component_id (smallest id
    reachable, its own included)."""
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    rows = df.select(df[id_col].cast("long").alias("id"), df[label_col].cast("string").alias("label"), df[vector_col].cast("array<double>").alias("v"))
    rows = rows.withColumn("fit", usable("v") & F.col("label").isNotNull())
    key = F.xxhash64("label", "v")
    same = rows.where("fit").groupBy("label", "v").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    # a class is named by a number that follows the order of its smallest id
    classes = staged(same.withColumn("key", key).withColumn("cls", F.struct("least", "key")), "pq-classes")
    sizes = [r["d"] for r in classes.select(F.size("v").alias("d")).distinct().collect()]
    parts = []
    for d in sorted(sizes):
        of_size = classes.where(F.size("v") == d)
        parts.append(links_of(of_size, threshold, radius, sample_rows, subspaces, codes, block_rows))
    found = rows.where("1 = 0").select(F.lit("").alias("cls"), F.lit(0).cast("long").alias("n"), F.lit("").alias("root"))
    for part in parts:
        found = found.unionByName(part)
    found = staged(found, "pq-links")
    counts = found.groupBy("cls").agg(F.sum("n").alias("linked"))
    groups = connected_components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")), "pq")
    named = classes.select(name("least", "key").alias("cls"), "least", "n", "key", "label")
    with_group = named.join(counts, "cls", "left").join(groups.withColumnRenamed("node", "cls"), "cls", "left")
    with_group = with_group.withColumn("component", F.coalesce("component", "cls"))
    smallest = with_group.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = with_group.join(smallest, "component").select(
        "label", "key", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    keyed = rows.select("id", F.when(F.col("fit"), F.col("label")).alias("label"), F.when(F.col("fit"), key).alias("key"))
    return keyed.join(of_class, ["label", "key"], "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )


def name(least: str, key: str):
    """A text that sorts as (least, key) for ids that are not negative and is unique."""
    return F.concat(F.lpad(F.hex(F.coalesce(F.col(least), F.lit(0))), 16, "0"), F.lit(":"), F.hex(F.col(key)))


def links_of(classes: DataFrame, threshold: float, radius: float, sample_rows: int, subspaces: int, codes: int, block_rows: int) -> DataFrame:
    fitted = sample(classes, "v", sample_rows, 3)
    fitted /= np.linalg.norm(fitted, axis=1, keepdims=True)
    total = classes.count()
    lists = int(np.clip(np.sqrt(total) / 2, 1, min(256, len(fitted))))
    q = Quantiser(fitted, lists, subspaces, codes)
    index = "label string, cls string, n long, unit array<double>, list int, codes binary, error double, probes array<int>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(3))
            if not len(x):
                continue
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
            owner, code, error = q.encode(x)
            row, probed = q.probes(x, radius)
            at = np.searchsorted(row, np.arange(len(x) + 1)).astype(np.int32)
            unit = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    unit,
                    pa.array(owner.astype(np.int32)),
                    pa.array([c.tobytes() for c in code], pa.binary()),
                    pa.array(error),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(probed.astype(np.int32))),
                ],
                names=["label", "cls", "n", "unit", "list", "codes", "error", "probes"],
            )

    coded = staged(classes.select("label", name("least", "key").alias("cls"), "n", "v").mapInArrow(encode, index), "pq-coded")
    # lists in blocks of bounded size, and the queries of a list too
    lens = coded.groupBy("label", "list").agg(F.count("*").alias("rows"))
    asked = coded.select("label", F.explode("probes").alias("list")).groupBy("label", "list").agg(F.count("*").alias("queries"))
    blocks = lens.join(asked, ["label", "list"]).select(
        "label", "list", F.ceil(F.col("rows") / block_rows).alias("cuts"), F.ceil(F.col("queries") / block_rows).alias("query_cuts")
    )
    blocks = staged(blocks, "pq-blocks")
    spot = F.xxhash64("cls")
    stored = coded.drop("probes").join(blocks, ["label", "list"])
    stored = stored.withColumn("cut", F.pmod(spot, F.col("cuts"))).withColumn("query_cut", F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_cuts") - 1)))
    queries = coded.select("label", "cls", "unit", F.explode("probes").alias("list")).join(blocks, ["label", "list"])
    queries = queries.withColumn("query_cut", F.pmod(spot, F.col("query_cuts"))).withColumn("cut", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)))
    cell = ["label", "list", "cut", "query_cut"]

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"cls": [], "n": [], "root": []})
        return block_links(q, left, right, threshold, radius)

    return (
        queries.select(*cell, "cls", "unit")
        .groupBy(*cell)
        .cogroup(stored.select(*(F.col(c).alias(c) for c in (*cell, "cls", "n", "unit", "codes", "error"))).groupBy(*cell))
        .applyInPandas(compare, "cls string, n long, root string")
    )
