"""Helpers of the training-data operators: staged tables, text batches, hashing, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.session import fresh_path

# Bytes of text that one vectorised step works on; a longer text is a step of its own.
STEP_BYTES = 1 << 18

# Odd multiplier of the polynomial hashes and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: computed once, and a lost
    executor costs no more than the tasks it was running."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# -- Arrow ------------------------------------------------------------------------------


def text_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def steps(offsets: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts together stay within `most` bytes where rows allow it."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


# -- hashing ----------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of a multiplier and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", BASE), ("down", BASE_INVERSE)):
                steps_ = np.full(size, base, np.uint64)
                steps_[0] = 1
                setattr(self, name, np.multiply.accumulate(steps_))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] the polynomial over values[i:j], times BASE**i."""
    up, _ = POWERS.upto(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Scrambled hashes of the spans [start, stop) by their content alone."""
    _, down = POWERS.upto(len(prefix))
    return mix((prefix[stop] - prefix[start]) * down[start] + (stop - start).astype(np.uint64))


def gram_hash(values: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` consecutive values."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    prefix = prefix_hash(values)
    _, down = POWERS.upto(len(prefix))
    return mix((prefix[size:] - prefix[:n]) * down[:n])


def words_by_text(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text of a batch: starts, stops, and offsets of texts into the words.

    No word runs over the end of its text.
    """
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    first = np.zeros(len(raw), bool)
    last = np.zeros(len(raw), bool)
    if len(raw):
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        first = ~space & (edge[:-1] | np.concatenate(([True], space[:-1])))
        last = ~space & (edge[1:] | np.concatenate((space[1:], [True])))
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, stops, np.searchsorted(starts, offsets)


# -- samples and groups -----------------------------------------------------------------


def seeded(seed: int, *columns) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def one_row_each(entries: DataFrame, count_col: str, step: int = 4096) -> DataFrame:
    """Every row as often as its `count_col` says, with `nth` from 0 instead of it; one that
    stands for many is written by many tasks."""
    steps_ = F.sequence(F.lit(0).cast("long"), F.expr(f"({count_col} - 1) div {step}"))
    dealt = entries.withColumn("nth_step", F.explode(steps_))
    dealt = dealt.repartition(*entries.columns, "nth_step")
    here = F.least(F.lit(step).cast("long"), F.col(count_col) - F.col("nth_step") * step) - 1
    rest = [c for c in entries.columns if c != count_col]
    rows = dealt.select(*rest, "nth_step", F.explode(F.sequence(F.lit(0).cast("long"), here)).alias("nth"))
    return rows.select(*rest, (F.col("nth_step") * step + F.col("nth")).alias("nth"))


def piece(text: Column, seed: int, most_bytes: int) -> Column:
    """The text, or of one with more bytes a seeded piece within them; a piece without a
    letter gives way to the one that starts with the text's first letter, if it has any."""
    most = most_bytes // 4  # characters of any size
    at = F.pmod(seeded(seed, text), F.greatest(F.length(text) - most, F.lit(1))).cast("int") + 1
    here = F.substring(text, at, F.lit(most))
    first = F.regexp_instr(text, F.lit(r"\p{L}"))
    chosen = F.when(here.rlike(r"\p{L}") | (first == 0), here).otherwise(F.substring(text, first, F.lit(most)))
    return F.when(F.octet_length(text) <= most_bytes, text).otherwise(chosen)


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b); component is the
    smallest node reachable.

    Each round gives a node the smallest label among itself, its neighbours and its label's
    own label; labels fall fast because they are followed as pointers. A round is staged,
    so lineage stays short.
    """
    both = edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = staged(both.distinct(), f"{label}-edges")
    nodes = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), label)
    while True:
        offers = both.join(nodes.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("offer"))
        # the label of a node's label, and what neighbours offer to the label itself
        hooks = nodes.join(offers, "node").groupBy(F.col("component").alias("node")).agg(F.min("offer").alias("hook"))
        lower = (
            nodes.join(offers, "node")
            .join(hooks, "node", "left")
            .select("node", F.col("component").alias("was"), F.least("component", "offer", "hook").alias("near"))
        )
        lower = staged(lower, label)
        jump = lower.select(F.col("node").alias("near"), F.col("near").alias("far"))
        after = staged(
            lower.join(jump, "near", "left").select("node", "was", F.least("near", "far").alias("component")), label
        )
        moved = after.where("component < was").limit(1).count()
        nodes = after.select("node", "component")
        if not moved:
            return nodes
