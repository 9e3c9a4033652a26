"""Sharding by Karmarkar-Karp differencing: shards of nearly equal bytes, equal texts together.

A group is all rows with one text; it never leaves its shard. Differencing starts with one
partial partition per group (its size in one part, nothing in the others) and repeatedly
combines the two partial partitions of largest spread, the largest part of one with the
smallest of the other.

Groups are dealt to buckets of a bounded number of groups by a digest, and each bucket is
differenced in a task. Groups above a fraction of a shard cannot be evened out within a
bucket: they are few (at most `HEAVY` per shard), are placed first, and each bucket gets its
share of the unevenness they leave as one more partial partition, whose parts name the
shards. So every bucket fills the same gaps in proportion, and what is left over is a few
bytes per bucket.

A group larger than a whole shard has a shard to itself as far as that goes; balance is then
as near as whole groups allow. Null text counts as empty. Repeated rows are members of their
group. An empty table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import one_row_each, staged

SHARDS = 16
BUCKET_GROUPS = 4096
HEAVY = 64


def difference(sizes: np.ndarray, shards: int, ballast: np.ndarray) -> np.ndarray:
    """Shard of each item: the parts of `ballast` are already in shards 0, 1, ...

    A partial partition is its part sums in falling order, each with the items in it as a
    tree of pairs; the ballast's parts carry their shard as item -1 - shard.
    """
    heap: list[tuple] = []
    count = 0

    def push(parts: list[tuple]) -> None:
        nonlocal count
        parts.sort(key=lambda p: (-p[0], p[1]))
        count += 1
        heapq.heappush(heap, (parts[-1][0] - parts[0][0], count, parts))

    push([(float(b), s, -1 - s) for s, b in enumerate(ballast)])
    for item, size in enumerate(sizes.tolist()):
        push([(size, shards, item)] + [(0, shards, None)] * (shards - 1))
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        push([(x[0] + y[0], min(x[1], y[1]), join(x[2], y[2])) for x, y in zip(a, reversed(b), strict=True)])
    out = np.zeros(len(sizes), np.int64)
    for _, shard, tree in heap[0][2]:
        stack = [tree]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += node
            elif node is not None and node >= 0:
                out[node] = shard
    return out


def join(a, b):
    if a is None:
        return b
    return a if b is None else (a, b)


def shard_by_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """Per row: id, size (UTF-8 bytes and one), text_crc32, shard, slot (from 0 in a shard)."""
    spark = df.sparkSession
    text = F.coalesce(df[text_col], F.lit("")).cast("binary")
    rows = staged(
        df.select(
            df[id_col].alias("id"),
            F.unhex(F.md5(text)).alias("tid"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
        ),
        "shard-rows",
    )
    groups = staged(rows.groupBy("tid").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).first()
    if not total["n"]:
        empty = rows.select("id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
        return empty
    # at most shards * HEAVY groups can be this large
    limit = max(1, total["bytes"] // (shards * HEAVY))
    heavy = sorted(groups.where(F.col("bytes") > limit).collect(), key=lambda r: (-r["bytes"], bytes(r["tid"])))
    sizes = np.array([r["bytes"] for r in heavy], np.int64)
    placed = difference(sizes, shards, np.zeros(shards))
    load = np.bincount(placed, sizes, minlength=shards) if len(heavy) else np.zeros(shards)
    buckets = -(-total["n"] // BUCKET_GROUPS)
    light_bytes = float(total["bytes"] - load.sum())

    def one_bucket(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bytes", "tid"], ascending=False, kind="stable")
        share = frame["bytes"].sum() / max(light_bytes, 1.0)
        frame["shard"] = difference(frame["bytes"].to_numpy(), shards, load * share).astype(np.int32)
        return frame[["tid", "shard"]]

    light = groups.where(F.col("bytes") <= limit).withColumn("bucket", F.pmod(F.xxhash64("tid"), F.lit(buckets)))
    dealt = light.groupBy("bucket").applyInPandas(one_bucket, "tid binary, shard int")
    fixed = spark.createDataFrame([(bytes(r["tid"]), int(s)) for r, s in zip(heavy, placed, strict=True)], "tid binary, shard int")
    return numbered(rows.join(dealt.unionByName(fixed), "tid"), shards)


def numbered(rows: DataFrame, shards: int) -> DataFrame:
    """`slot`: gapless numbers within a shard. Rows equal in id and text are one entry with
    their number; entries are numbered within small ranges, and a range starts where the ones
    before it end."""
    entries = staged(rows.groupBy("shard", "id", "tid", "size", "text_crc32").agg(F.count("*").alias("n")), "shard-entries")
    ranges = max(1, entries.count() // (BUCKET_GROUPS * shards))
    ranged = entries.withColumn("range", F.pmod(F.xxhash64("id", "tid"), F.lit(ranges)))
    counts = ranged.groupBy("shard", "range").agg(F.sum("n").alias("rows"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "range").orderBy("id", "tid").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        ranged.withColumn("place", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(starts, ["shard", "range"])
        .select("id", "size", "text_crc32", "shard", "n", (F.col("base") + F.col("place")).cast("long").alias("first"))
    )
    return one_row_each(placed, "n").select("id", "size", "text_crc32", "shard", (F.col("first") + F.col("nth")).alias("slot"))
