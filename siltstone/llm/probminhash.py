"""Near-duplicate documents by ProbMinHash sketches, banding and verification.

A document is the set of its shingles (`shingle` consecutive words), each with a weight that
grows with the logarithm of its count. Every shingle is a Poisson process whose rate is its
weight; an arrival falls into a random register, and a register keeps the shingle that
arrives first. A shingle stops as soon as its next arrival comes after all registers are
taken earlier, so most shingles make one draw. Two sketches agree in a register with the
probability Jaccard similarity of the documents. A document with repeated shingles is sketched
a second time with equal weights: then the probability is the Jaccard similarity of the sets,
however often a passage is repeated in one of them.

Bands of registers of both sketches nominate pairs, which are verified by the exact Jaccard
similarity of their shingle sets (at least `threshold`). Without repeated shingles the two
sketches are one, and so are their keys. Documents of one group are linked, not paired:

* equal texts are one class from the start and are sketched once;
* in a band's bucket every member is compared with one member, its hub, a different one per
  bucket. A member that this leaves outside its hub's component is then compared with that
  whole component and with the others left outside it, in cells of bounded size that return
  a spanning set of links. No link between members of a bucket that would join two groups is
  left out; a group of near copies costs a multiple of its size, and its members that are
  near to no hub cost one pass over the group each.

A document with fewer words than a shingle has one shingle, all its words. Documents without
words (null, empty, white space) are near nothing but their exact copies. Repeated rows are
copies. Null ids form one id. An empty table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import (
    connected_components,
    mix,
    prefix_hash,
    span_hash,
    staged,
    steps,
    text_spans,
    words_by_text,
)

SHINGLE, THRESHOLD, BANDS, ROWS = 5, 0.8, 20, 5
# Documents of either side that one task compares at a time.
CELL_ROWS = 512


def shingles(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text, hash (sorted within the text), count."""
    starts, stops, at = words_by_text(raw, offsets)
    words = span_hash(prefix_hash(raw), starts, stops)
    prefix = prefix_hash(words)
    n = np.diff(at)
    # one shingle per place where `size` words follow, and one for a shorter text
    many = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    text = np.repeat(np.arange(len(n)), many)
    first = at[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    h = span_hash(prefix, first, np.minimum(first + size, at[1:][text]))
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])))) if len(h) else np.zeros(0, int)
    count = np.diff(np.concatenate((new, [len(h)])))
    return text[new], h[new], count


def sketch(text: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """n x registers: the shingle that arrives first in each register (0: no shingles)."""
    arrival = np.full(n * registers, np.inf)
    owner = np.zeros(n * registers, np.uint64)
    latest = np.full(n, np.inf)
    time = np.zeros(len(h))
    draw = 0
    while len(h):
        draw += 1
        r = mix(h ^ mix(np.array([draw], np.uint64)))
        u = ((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(u) / weight
        early = time < latest[text]
        text, h, weight, time, r = text[early], h[early], weight[early], time[early], r[early]
        slot = text * registers + (mix(r) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(arrival, slot, time)
        won = arrival[slot] == time
        owner[slot[won]] = h[won]
        latest = arrival.reshape(n, registers).max(axis=1)
        early = time < latest[text]
        text, h, weight, time = text[early], h[early], weight[early], time[early]
    return owner.reshape(n, registers)


def band_keys(owner: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """n x bands: one key per band of `rows` registers."""
    key = np.zeros((len(owner), bands), np.uint64)
    for row in range(rows):
        key = mix(key * np.uint64(31) + owner[:, row::rows] + np.uint64(row))
    return mix(key + np.arange(bands, dtype=np.uint64))


def set_sketch(text: np.ndarray, h: np.ndarray, count: np.ndarray, weighted: np.ndarray) -> np.ndarray:
    """The sketches with equal weights; those of texts without repeats are the weighted ones."""
    n, registers = weighted.shape
    repeats = np.bincount(text[count > 1], minlength=n) > 0
    again = repeats[text]
    row = np.cumsum(repeats) - 1
    owner = weighted.copy()
    owner[repeats] = sketch(row[text[again]], h[again], np.ones(int(again.sum())), int(repeats.sum()), registers)
    return owner


def sketches(df: DataFrame, id_col: str, text_col: str, shingle: int, bands: int, rows: int) -> DataFrame:
    """(id, tid, n, keys): text identity, number of shingles, one key per band, and a second
    one where the bands of the two sketches differ."""
    schema = "id long, tid binary, n long, keys array<long>"
    registers = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_spans(batch.column(1))
            for lo, hi in steps(offsets):
                o = offsets[lo : hi + 1] - offsets[lo]
                part = raw[offsets[lo] : offsets[hi]]
                text, h, count = shingles(part, o, shingle)
                many = np.bincount(text, minlength=hi - lo)
                owner = sketch(text, h, 1 + np.log2(count), hi - lo, registers)
                plain = set_sketch(text, h, count, owner)
                key = np.hstack([band_keys(owner, bands, rows), band_keys(plain, bands, rows)])
                used = np.repeat((many > 0)[:, None], 2 * bands, axis=1)
                used[:, bands:] &= key[:, bands:] != key[:, :bands]
                at = np.concatenate(([0], np.cumsum(used.sum(axis=1)))).astype(np.int32)
                flat = pa.array(key[used].view(np.int64))
                tid = [hashlib.md5(part[a:b].tobytes(), usedforsecurity=False).digest() for a, b in zip(o[:-1], o[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(tid, pa.binary()), pa.array(many.astype(np.int64)), pa.ListArray.from_arrays(pa.array(at), flat)],
                    names=["id", "tid", "n", "keys"],
                )

    return df.select(df[id_col].cast("long").alias("id"), df[text_col].alias("text")).mapInArrow(run, schema)


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, set): the sorted distinct shingles of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_spans(batch.column(1))
            for lo, hi in steps(offsets):
                o = offsets[lo : hi + 1] - offsets[lo]
                text, h, _ = shingles(raw[offsets[lo] : offsets[hi]], o, shingle)
                at = np.searchsorted(text, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(at), pa.array(h.view(np.int64)))],
                    names=["node", "set"],
                )

    return texts.mapInArrow(run, "node binary, set array<long>")


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, similarity) of distinct pairs."""
    a = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    b = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    similarity = common / (F.size("set_a") + F.size("set_b") - common)
    return pairs.join(a, "a").join(b, "b").select("a", "b", similarity.alias("similarity"))


def outside_links(outside: DataFrame, inside: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links that join the rows of `outside` to each other and to `inside`, group by
    group of `meets`. Cells of bounded size compare one block of either side and return a
    spanning set of their links."""
    everyone = inside.unionByName(outside).distinct()
    left_cuts = outside.groupBy("meets").agg(F.ceil(F.count("*") / CELL_ROWS).alias("cuts"))
    right_cuts = everyone.groupBy("meets").agg(F.ceil(F.count("*") / CELL_ROWS).alias("other_cuts"))
    cuts = left_cuts.join(right_cuts, "meets")
    spot = F.xxhash64("tid")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    sized = sets.withColumnRenamed("node", "tid")
    left = outside.join(cuts, "meets").withColumn("cut", F.pmod(spot, "cuts")).withColumn("other", each("other_cuts"))
    right = everyone.join(cuts, "meets").withColumn("other", F.pmod(spot, "other_cuts")).withColumn("cut", each("cuts"))
    cell = ["meets", "cut", "other"]

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"a": [], "b": []})
        return cell_links(list(a["tid"]), list(a["set"]), list(b["tid"]), list(b["set"]), threshold)

    left = left.select(*cell, "tid").join(sized, "tid")
    right = right.select(*cell, "tid").join(sized, "tid").select(*cell, "tid", "set")
    right = right.select(*(F.col(c).alias(c) for c in right.columns))  # own columns: both sides use `sets`
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(compare, "a binary, b binary")


def cell_links(a_ids: list, a_sets: list, b_ids: list, b_sets: list, threshold: float) -> pd.DataFrame:
    sizes = np.array([len(s) for s in b_sets])
    values = np.concatenate(b_sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], np.repeat(np.arange(len(b_sets)), sizes)[order]
    found: list[tuple[int, int]] = []
    for i, (tid, one) in enumerate(zip(a_ids, a_sets, strict=True)):
        lo, hi = np.searchsorted(values, one, "left"), np.searchsorted(values, one, "right")
        many = hi - lo
        at = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())
        common = np.bincount(owner[at], minlength=len(b_sets))
        near = np.flatnonzero(common >= threshold * (len(one) + sizes - common) - 1e-9)
        found += [(i, j) for j in near.tolist() if b_ids[j] != tid]
    # a spanning set of these links
    root: dict[bytes, bytes] = {}

    def top(x: bytes) -> bytes:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for i, j in found:
        x, y = top(a_ids[i]), top(b_ids[j])
        if x != y:
            root[max(x, y)] = min(x, y)
            links.append((a_ids[i], b_ids[j]))
    return pd.DataFrame(links, columns=["a", "b"])


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Per row: the id, tid (text identity), component_id (the smallest id of its group),
    kept_tid (the text of its group with that id, the smallest of several; ids may be null or
    repeated, texts of a group are not) and n_class (rows with an equal text)."""
    all_rows = staged(sketches(df, id_col, text_col, shingle, bands, rows), "probminhash")
    classes = all_rows.groupBy("tid").agg(F.min("id").alias("rep"), F.count("*").alias("n_class"))
    # one row per text; the keys of equal texts are equal
    alone = all_rows.select("tid", F.explode("keys").alias("key")).select("key", "tid").distinct()
    crowd = alone.groupBy("key").agg(F.count("*").alias("size"), F.min_by("tid", F.xxhash64("tid", "key")).alias("hub")).where("size > 1")
    bucket = staged(alone.join(crowd, "key").select("key", "tid", "hub"), "probminhash-buckets")

    # shingle sets of the texts that share a bucket
    text = F.coalesce(df[text_col], F.lit(""))
    texts = df.select(df[id_col].cast("long").alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("tid"), text.alias("text"))
    wanted = bucket.select("tid").distinct().join(classes, "tid").select("tid", "rep")
    chosen = texts.join(wanted, "tid").where(F.col("id").eqNullSafe(F.col("rep"))).groupBy("tid").agg(F.first("text").alias("text"))
    sets = staged(shingle_sets(chosen.select(F.col("tid").alias("node"), "text"), shingle), "probminhash-sets")

    hubs = bucket.where("tid <> hub").select(F.least("tid", "hub").alias("a"), F.greatest("tid", "hub").alias("b")).distinct()
    seen = staged(similarities(hubs, sets), "probminhash-hubs")
    first = seen.where(F.col("similarity") >= threshold)
    grouped = connected_components(first.select("a", "b"), "probminhash-first")

    # members outside their hub's component meet all of it, and each other
    parts = grouped.select(F.col("node").alias("tid"), F.col("component").alias("part"))
    placed = (
        bucket.where("tid <> hub")
        .join(parts, "tid", "left")
        .join(parts.select(F.col("tid").alias("hub"), F.col("part").alias("hub_part")), "hub", "left")
        .select("tid", F.coalesce("part", "tid").alias("part"), F.coalesce("hub_part", "hub").alias("meets"))
    )
    outside = staged(placed.where("part <> meets").select("meets", "tid").distinct(), "probminhash-outside")
    whole = parts.select(F.col("part").alias("meets"), "tid").unionByName(
        outside.select("meets", F.col("meets").alias("tid"))  # a hub without links is its own component
    )
    inside = whole.join(outside.select("meets").distinct(), "meets").distinct()
    more = outside_links(outside, inside, sets, threshold)
    links = first.select("a", "b").unionByName(more)
    groups = connected_components(links, "probminhash-second")

    least = F.min(F.struct(F.col("rep").isNull().alias("no_id"), "rep", "tid"))  # a null id comes last
    smallest = groups.join(classes, groups["node"] == classes["tid"]).groupBy("component").agg(least.alias("least"))
    of_text = groups.join(smallest, "component").select(
        F.col("node").alias("tid"), F.col("least.rep").alias("component_id"), F.col("least.tid").alias("kept_tid")
    )
    return (
        all_rows.select("id", "tid")
        .join(classes, "tid")
        .join(of_text, "tid", "left")
        .select(F.col("id").alias(id_col), "tid", F.coalesce("component_id", "rep").alias("component_id"), F.coalesce("kept_tid", "tid").alias("kept_tid"), "n_class")
    )
