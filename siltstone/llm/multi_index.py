"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: one more component makes all lengths equal, so that the largest
inner product is the smallest angle; a learned rotation (principal directions, then turns
that bring the components near their signs) gives the bits, two rotations for twice as many.
A code is cut into substrings and every substring is indexed. Two codes within Hamming
distance R differ by at most R // m in one of the first R % m + 1 of m substrings, or by at
most R // m - 1 in one of the others: probing these balls around a query's substrings meets
every code within R. What is met at distance R or less is ranked by the exact inner product
of the vectors in double precision.

The rotation is fitted on a bounded sample; every row is indexed. R is the quantile `reach`
of the code distances between `calibration_queries` queries, picked by a hash, and their true
neighbours among all rows, which one pass over the rows finds.

The index is dealt by substring number and the leading bits of its value, in blocks of
bounded size; a query travels to the parts its balls touch. A task returns the best `k` per
query, never its candidates. A pair is ranked only under the first substring that meets it.

Vectors that are null, empty, zero or hold null or non-finite components take no part. Vectors of
different lengths are searched apart from each other. Ties go to the smaller id; a query's own row
is no candidate, but other rows of its id are. Repeated rows are queries and candidates each. A query that met fewer than `k` looks again
with the largest radius, so all candidates are returned where there are fewer. An empty table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import staged
from siltstone.llm.vectors import matrix, sample, usable

K, ROTATIONS, SUBSTRING_BITS, LEAD_BITS = 20, 2, 8, 4
SAMPLE_ROWS, CALIBRATION_QUERIES, REACH = 4000, 64, 0.97
BLOCK_ROWS = 8192

POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class Coder:
    def __init__(self, x: np.ndarray, longest: float, rotations: int = ROTATIONS, rounds: int = 20) -> None:
        self.longest = longest
        wide = self.widen(x)
        self.mean = wide.mean(axis=0)
        centered = wide - self.mean
        d = -(-centered.shape[1] // SUBSTRING_BITS) * SUBSTRING_BITS
        centered = np.hstack([centered, np.zeros((len(x), d - centered.shape[1]))])
        _, _, directions = np.linalg.svd(centered[: min(len(x), 2000)], full_matrices=True)
        self.turns = []
        for seed in range(rotations):
            rng = np.random.default_rng(seed)
            turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
            projected = centered @ directions.T
            for _ in range(rounds):
                signs = np.where(projected @ turn >= 0, 1.0, -1.0)
                u, _, v = np.linalg.svd(signs.T @ projected)
                turn = (u @ v).T
            self.turns.append(directions.T @ turn)
        self.width = d

    def widen(self, x: np.ndarray) -> np.ndarray:
        """Rows scaled by the longest, with a component that makes their length 1."""
        y = x / self.longest
        rest = np.sqrt(np.maximum(0, 1 - (y * y).sum(axis=1)))
        return np.hstack([y, rest[:, None]])

    def codes(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Bytes of the codes; a query's length does not matter, so it is scaled to 1."""
        if query:
            y = np.hstack([x / np.sqrt((x * x).sum(axis=1, keepdims=True)), np.zeros((len(x), 1))])
        else:
            y = self.widen(x)
        y = y - self.mean
        y = np.hstack([y, np.zeros((len(x), self.width - y.shape[1]))])
        return np.packbits(np.hstack([y @ t >= 0 for t in self.turns]), axis=1)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties by smaller id."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))][:k]


def inner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products summed component by component, the same for every block shape."""
    total = np.zeros(np.broadcast_shapes(x.shape[:-1], y.shape[:-1]))
    for i in range(x.shape[-1]):
        total += x[..., i] * y[..., i]
    return total


def nearest_true(x: np.ndarray, ids: np.ndarray, v: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    scores = x @ v.T
    for i in range(len(x)):
        row = np.where(ids == own[i], -np.inf, scores[i])
        yield i, best(row, ids, min(k, int((ids != own[i]).sum())))


def radius_of(rows: DataFrame, coder: Coder, queries: pd.DataFrame, k: int, reach: float) -> int:
    """The quantile of code distances between the given queries and their true neighbours."""
    x, own = np.stack(queries["v"]), queries["id"].to_numpy()
    asked = coder.codes(x, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, v = batch.column(0).to_numpy(), matrix(batch.column(1))
            code = coder.codes(v, False)
            out: list[tuple] = []
            for i, at in nearest_true(x, ids, v, own, k):
                apart = POPCOUNT[code[at] ^ asked[i]].sum(axis=1)
                out += zip([i] * len(at), (v[at] @ x[i]).tolist(), apart.tolist(), strict=True)
            columns = list(zip(*out, strict=True)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.int32())], names=["q", "score", "apart"]
            )

    # a batch gives k rows per query at most, and only the k best stay
    met = rows.select("id", "v").mapInArrow(run, "q int, score double, apart int")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "apart")
    top = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("apart").collect()
    return int(np.quantile([r["apart"] for r in top], reach, method="higher")) if top else 0


def search(
    df: DataFrame,
    queries: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    rotations: int = ROTATIONS,
    sample_rows: int = SAMPLE_ROWS,
    calibration_queries: int = CALIBRATION_QUERIES,
    reach: float = REACH,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, id, score): the `k` nearest found for each row where `queries` holds."""
    empty = "query_id long, rank int, id long, score double"
    rows = df.select(
        df[id_col].cast("long").alias("name"), df[vector_col].cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")
    ).where(usable("v") & F.col("name").isNotNull())
    # rows are told apart by a number of their own, which is fixed once it is written
    rows = staged(rows.withColumn("id", F.monotonically_increasing_id()), "mih-rows")
    found = df.sparkSession.createDataFrame([], empty)
    # one row per length of vectors
    for d in sorted(r["d"] for r in rows.select(F.size("v").alias("d")).distinct().collect()):
        alike = rows.where(F.size("v") == d)
        if alike.where("asks").limit(1).count():
            found = found.unionByName(search_alike(alike, k, rotations, sample_rows, calibration_queries, reach, block_rows))
    return found


def search_alike(
    rows: DataFrame, k: int, rotations: int, sample_rows: int, calibration_queries: int, reach: float, block_rows: int
) -> DataFrame:
    """The search among rows (id, name, v, asks) whose vectors have one length."""
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    longest = rows.agg(F.max(length)).first()[0]
    coder = Coder(sample(rows, "v", sample_rows, 21), longest, rotations)
    asked = rows.where("asks").orderBy(F.xxhash64(F.lit(5), "id"), "id").limit(calibration_queries).select("id", "v").toPandas()
    radius = radius_of(rows, coder, asked, k, reach)

    total = rows.count()
    bits = coder.width * rotations
    if total <= k + 1:
        radius = bits
    asks = rows.where("asks").select("id", "v", "name")
    found = staged(probe(rows, asks, coder, radius, k, total, block_rows), "mih-found")
    # whoever met too few looks again, without a limit to the distance
    enough = found.groupBy("asker").agg(F.count("*").alias("met")).where(F.col("met") >= min(k, total - 1))
    short = staged(asks.join(enough, asks["id"] == enough["asker"], "left_anti"), "mih-short")
    if short.limit(1).count():
        again = probe(rows, short, coder, bits, k, total, block_rows)
        found = found.join(short.select(F.col("id").alias("asker")), "asker", "left_anti").unionByName(again)
    return found.select("query_id", "rank", "id", "score")


def probe(rows: DataFrame, asks: DataFrame, coder: Coder, radius: int, k: int, total: int, block_rows: int) -> DataFrame:
    """(asker, query_id, rank, id, score): the best of all rows whose code is within `radius`; `asker`
    is the number of the query's row, `query_id` and `id` are names."""
    parts = coder.width * len(coder.turns) // SUBSTRING_BITS
    each = np.array([radius // parts - (j > radius % parts) for j in range(parts)])
    used = [j for j in range(parts) if each[j] >= 0]
    lead = SUBSTRING_BITS - LEAD_BITS
    # leading bits that some value within the ball can have
    leads = {(j, v): sorted({w >> lead for w in range(256) if POPCOUNT[v ^ w] <= each[j]}) for j in used for v in range(256)}
    schema = "part int, lead int, id long, code binary, v array<double>, name long"

    def places(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                code = coder.codes(matrix(batch.column(1)), query)
                row, part, first = [], [], []
                for j in used:
                    for i, v in enumerate(code[:, j].tolist()):
                        for w in leads[j, v] if query else (v >> lead,):
                            row.append(i)
                            part.append(j)
                            first.append(w)
                take = pa.array(row, pa.int64())
                codes = pa.array([c.tobytes() for c in code], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), pa.array(first, pa.int32()), batch.column(0).take(take), codes.take(take), batch.column(1).take(take), batch.column(2).take(take)],
                    names=["part", "lead", "id", "code", "v", "name"],
                )

        return run

    index = rows.select("id", "v", "name").mapInArrow(places(False), schema)
    probes = asks.mapInArrow(places(True), schema)
    cuts = max(1, -(-total // (block_rows << LEAD_BITS)))
    query_cuts = max(1, -(-asks.count() // block_rows))
    spot = F.xxhash64("id")
    number = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = index.withColumn("cut", F.pmod(spot, F.lit(cuts)).cast("int")).withColumn("query_cut", number(query_cuts))
    probes = probes.withColumn("query_cut", F.pmod(spot, F.lit(query_cuts)).cast("int")).withColumn("cut", number(cuts))
    cell = ["part", "lead", "cut", "query_cut"]

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"asker": [], "query_id": [], "id": [], "score": []})
        return cell_best(a, b, int(a["part"].iloc[0]), each, radius, k)

    found = probes.groupBy(*cell).cogroup(index.groupBy(*cell)).applyInPandas(meet, "asker long, query_id long, id long, score double")
    order = Window.partitionBy("asker").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("asker", "query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def cell_best(a: pd.DataFrame, b: pd.DataFrame, part: int, each: np.ndarray, radius: int, k: int) -> pd.DataFrame:
    """The best k candidates of one cell for each of its queries."""
    qx, qc, qid = np.stack(a["v"]), np.frombuffer(b"".join(a["code"]), np.uint8).reshape(len(a), -1), a["id"].to_numpy()
    x, code, ids = np.stack(b["v"]), np.frombuffer(b"".join(b["code"]), np.uint8).reshape(len(b), -1), b["id"].to_numpy()
    asker, names = a["name"].to_numpy(), b["name"].to_numpy()
    words = -(-code.shape[1] // 8) * 8
    wide = np.zeros((len(code), words), np.uint8)
    wide[:, : code.shape[1]] = code
    wide = wide.view(np.uint64)
    out: list[tuple] = []
    by_value = {v: np.flatnonzero(code[:, part] == v) for v in np.unique(code[:, part]).tolist()}
    for i in range(len(qx)):
        v = int(qc[i, part])
        at = [rows for w, rows in by_value.items() if POPCOUNT[v ^ w] <= each[part]]
        if not at:
            continue
        at = np.concatenate(at)
        own = np.zeros(words, np.uint8)
        own[: code.shape[1]] = qc[i]
        apart = np.bitwise_count(wide[at] ^ own.view(np.uint64)).sum(axis=1)
        at = at[(apart <= radius) & (ids[at] != qid[i])]
        if part and len(at):
            # met before under an earlier substring
            earlier = POPCOUNT[code[at, :part] ^ qc[i, :part]] <= each[:part]
            at = at[~earlier.any(axis=1)]
        if len(at):
            score = inner(x[at], qx[i])
            top = best(score, names[at], k)
            out += zip([int(qid[i])] * len(top), [int(asker[i])] * len(top), names[at[top]].tolist(), score[top].tolist(), strict=True)
    return pd.DataFrame(out, columns=["asker", "query_id", "id", "score"])
