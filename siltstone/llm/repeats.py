"""What the two repeated-window operators share: anchors, candidate segments, marks, results.

Both look for windows of `length` units (words or bytes) whose content starts at more than
one place. A window's anchor is the gram of `gram` units with the smallest hash in it (the
leftmost of equals): it depends on the window's content alone, so equal windows have equal
anchors. Consecutive windows with one anchor form a segment. Where text repeats with a short
period (a run of one byte) the anchor moves on with the windows but keeps its hash; such a run
is one segment too, however long, and counts as one segment per window.

1. *Profile*: one pass over the texts gives per text its identity, size, digest and segments.
2. *Candidates*: an anchor that occurs once cannot be in a repeated window. Anchors are
   counted with map-side combining, and only segments whose anchor occurs again go on.
3. *Texts*: candidate texts, one of each group of equal ones, meet their segments once.
4. *Strings*: the string that a segment's windows cover is named by its digest. Names are
   counted with map-side combining: a string at several places repeats all its windows, and
   one of its places stands for all, so a hot passage is one row of its anchor's bucket.
5. *Marks*: the operator's own method counts windows exactly within a bucket. A bucket of very
   many different strings is dealt again by a longer gram, which cuts its strings into shorter
   runs of windows, and so on, at last by whole windows.
6. *Results*: marked runs go back to their text, which is cut.

A text that occurs more than once is repeated as a whole: all its windows are, and its
copies need neither marks nor their text.

Text identities are 128-bit digests of the content, so ids may be null or repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.common import (
    BASE,
    gram_hash,
    mix,
    prefix_hash,
    span_hash,
    staged,
    steps,
    text_spans,
    words_by_text,
)

# Different strings of one bucket that a task takes together; a larger bucket is dealt again.
BUCKET = 4096
# Windows of a run that travel as one string, and bytes of strings that travel together.
RUN_WINDOWS, BODY_BYTES = 1 << 14, 1 << 18
# Windows that one sorting step takes together.
SORT_WINDOWS = 200_000


@dataclass(frozen=True)
class Windows:
    """Windows of `length` units; unit is "word" or "byte"."""

    unit: str
    length: int
    gram: int

    @property
    def next(self) -> Windows:
        """The same windows with a gram half as far from the whole window."""
        return replace(self, gram=self.gram + (self.length - self.gram + 1) // 2)

    @property
    def most(self) -> int:
        """Windows that can share an anchor at one place; a segment of more is a run."""
        return self.length - self.gram + 1


# -- anchors ----------------------------------------------------------------------------


def sliding_anchor(hashes: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of each `width` consecutive hashes, the leftmost of equals.

    Minima over a window are the smaller of a suffix minimum of one block and a prefix
    minimum of the next; a position in the low bits breaks ties.
    """
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.int64)
    bits = np.uint64(24)  # above any position in a piece
    key = ((hashes >> bits) << bits) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = key
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
    return (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


# Windows whose anchors are sought at once; longer texts are taken in overlapping pieces.
PIECE = 1 << 18


def joined(text: np.ndarray, first: np.ndarray, count: np.ndarray, at: np.ndarray, anchor: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """Neighbouring segments whose anchors have equal hashes, as one where they hold more than
    `most` windows."""
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))))
    total = np.add.reduceat(count, new)
    run = total > most
    keep = ~np.repeat(run, np.diff(np.concatenate((new, [len(text)]))))
    keep[new] = True
    count = count.copy()
    count[new[run]] = total[run]
    return text[keep], first[keep], count[keep], at[keep], anchor[keep]


def segments_of(values: np.ndarray, offsets: np.ndarray, w: Windows) -> tuple[np.ndarray, ...]:
    """Segments of a batch: text, first window, number of windows, anchor, anchor's hash.

    `offsets` are those of the texts in `values`; positions are within the text.
    """
    found: list[tuple[np.ndarray, ...]] = []
    n = len(values)
    for lo in range(0, max(1, n - w.length + 1), PIECE):
        part = values[lo : lo + PIECE + w.length - 1]
        grams = gram_hash(part, w.gram)
        at = sliding_anchor(grams, w.length - w.gram + 1)
        if not len(at):
            continue
        start = np.arange(len(at)) + lo
        text = np.searchsorted(offsets, start, "right") - 1
        ok = start + w.length <= offsets[text + 1]
        start, text, at, anchor = start[ok], text[ok], at[ok] + lo, grams[at[ok]]
        if not len(start):
            continue
        new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (text[1:] != text[:-1]))))
        count = np.diff(np.concatenate((new, [len(start)])))
        base = offsets[text[new]]
        found.append(joined(text[new], start[new] - base, count, at[new] - base, anchor[new], w.most))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


# -- profile ----------------------------------------------------------------------------

_SEGMENT = pa.struct([("anchor", pa.int64()), ("first", pa.int32()), ("count", pa.int32()), ("at", pa.int32())])


def profile(df: DataFrame, keep: list[str], text_col: str, w: Windows) -> DataFrame:
    """Per row: `keep`, tid, units, sha (of the text as it would be kept whole), segments."""
    schema = T.StructType(list(df.select(*keep).schema.fields))
    schema.add("tid", "binary").add("units", "long").add("sha", "string")
    segment = T.StructType().add("anchor", "long").add("first", "integer").add("count", "integer").add("at", "integer")
    schema.add("segments", T.ArrayType(segment))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_spans(batch.column(batch.num_columns - 1))
            for lo, hi in steps(offsets):
                o = offsets[lo : hi + 1] - offsets[lo]
                part = raw[offsets[lo] : offsets[hi]]
                if w.unit == "word":
                    starts, stops, at = words_by_text(part, o)
                    values = span_hash(prefix_hash(part), starts, stops)
                else:
                    values, at = part, o
                whole = [part[a:b].tobytes() for a, b in zip(o[:-1], o[1:], strict=True)]
                tid = [hashlib.md5(t, usedforsecurity=False).digest() for t in whole]
                sha = [hashlib.sha256(b" ".join(t.split()) if w.unit == "word" else t).hexdigest() for t in whole]
                text, first, count, anchor_at, anchor = segments_of(values, at, w)
                fields = [
                    pa.array(anchor.view(np.int64)),
                    pa.array(first.astype(np.int32)),
                    pa.array(count.astype(np.int32)),
                    pa.array(anchor_at.astype(np.int32)),
                ]
                rows = np.searchsorted(text, np.arange(hi - lo + 1)).astype(np.int32)
                nested = pa.ListArray.from_arrays(pa.array(rows), pa.StructArray.from_arrays(fields, fields=list(_SEGMENT)))
                kept = [c.slice(lo, hi - lo) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(tid, pa.binary()), pa.array(np.diff(at)), pa.array(sha), nested],
                    names=[*keep, "tid", "units", "sha", "segments"],
                )

    chosen = df.select(*(df[c] for c in keep), df[text_col].alias("_text"))
    return chosen.mapInArrow(run, schema)


# -- candidates and texts ---------------------------------------------------------------


def candidates(rows: DataFrame, w: Windows) -> DataFrame:
    """(tid, anchor, first, count) of segments whose anchor occurs again, also in a run."""
    each = rows.select("tid", F.explode("segments").alias("s")).select("tid", "s.*")
    places = F.when(F.col("count") > w.most, F.col("count")).otherwise(1)
    again = each.groupBy("anchor").agg(F.sum(places).alias("n")).where("n > 1")
    return each.join(again, "anchor").select("tid", "anchor", "first", "count")


def candidate_texts(df: DataFrame, id_col: str, text_col: str, rows: DataFrame, w: Windows) -> DataFrame:
    """(tid, copies, text, segments) of the texts that have candidates.

    Of equal texts the row with the smallest id stands for all; rows that are equal in the
    id too all stay, which only makes their windows repeat, as they do.
    """
    grouped = candidates(rows, w).groupBy("tid").agg(F.collect_set(F.struct("first", "count", "anchor")).alias("segments"))
    classes = rows.groupBy("tid").agg(F.count("*").alias("copies"), F.min(id_col).alias("rep"))
    text = F.coalesce(df[text_col], F.lit(""))
    texts = df.select(F.unhex(F.md5(text.cast("binary"))).alias("tid"), df[id_col].alias("id"), text.alias("text"))
    chosen = texts.join(grouped.join(classes, "tid"), "tid").where(F.col("id").eqNullSafe(F.col("rep")))
    return chosen.select("tid", "copies", "text", "segments")


# -- strings ----------------------------------------------------------------------------

# A place: the windows first, first + 1, ... of a text that one string covers.
PLACE = "anchor long, name binary, tid binary, first int, count int"


class Strings:
    """Strings on their way out of a task, in batches of bounded size."""

    def __init__(self, w: Windows, bodies: bool) -> None:
        self.w, self.bodies = w, bodies
        self.clear()

    def clear(self) -> None:
        self.out: list[list] = [[], [], [], [], [], []]
        self.size = 0

    def cut(self, units: list[bytes] | bytes, anchor: int, tid: bytes, first: int, count: int, base: int) -> Iterator[pa.RecordBatch]:
        """The string of windows [first, first + count) of `units`, a long run's in several;
        `base` is the place of `units` in the text. Words are joined by one space."""
        for lo in range(first, first + count, RUN_WINDOWS):
            n = min(RUN_WINDOWS, first + count - lo)
            body = units[lo : lo + n + self.w.length - 1]
            body = b" ".join(body) if self.w.unit == "word" else body
            name = hashlib.md5(body, usedforsecurity=False).digest()
            for values, value in zip(self.out, (anchor, name, tid, base + lo, n, body if self.bodies else b""), strict=True):
                values.append(value)
            self.size += len(body)
            if self.size >= BODY_BYTES:
                yield self.batch()

    def batch(self) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
        names = ["anchor", "name", "tid", "first", "count", "body"]
        columns = [pa.array(c, k) for c, k in zip(self.out, kinds, strict=True)]
        keep = 6 if self.bodies else 5
        self.clear()
        return pa.RecordBatch.from_arrays(columns[:keep], names=names[:keep])


def units_of(raw: bytes, w: Windows) -> list[bytes] | bytes:
    return raw.split() if w.unit == "word" else raw


def strings(texts: DataFrame, w: Windows, bodies: bool) -> DataFrame:
    """A row per place of the segments of (tid, text, segments); with its string where `bodies`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Strings(w, bodies)
        for batch in batches:
            raw, offsets = text_spans(batch.column(1))
            stops = np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False))
            flat = batch.column(2).flatten()
            first, count, anchor = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("first", "count", "anchor"))
            for i, tid in enumerate(batch.column(0).to_pylist()):
                units = units_of(raw[offsets[i] : offsets[i + 1]].tobytes(), w)
                for at in range(stops[i - 1] if i else 0, stops[i]):
                    yield from out.cut(units, int(anchor[at]), tid, int(first[at]), int(count[at]), 0)
            yield out.batch()

    return texts.select("tid", "text", "segments").mapInArrow(run, PLACE + (", body binary" if bodies else ""))


def dealt_again(rows: DataFrame, w: Windows, bodies: bool) -> DataFrame:
    """A row per place of the segments that `w` cuts the strings (anchor, tid, first, body) into.

    The new bucket is that of the old anchor and the new one: equal windows share both.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Strings(w, bodies)
        for batch in batches:
            for anchor, tid, base, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = np.frombuffer(body, np.uint8)
                values = raw
                if w.unit == "word":
                    starts, stops, _ = words_by_text(raw, np.array([0, len(raw)]))
                    values = span_hash(prefix_hash(raw), starts, stops)
                _, first, count, _, new = segments_of(values, np.array([0, len(values)]), w)
                both = mix(new + np.array([anchor], np.int64).view(np.uint64) * np.uint64(BASE)).view(np.int64)
                units = units_of(body, w)
                for key, lo, n in zip(both.tolist(), first.tolist(), count.tolist(), strict=True):
                    yield from out.cut(units, key, tid, lo, n, base)
            yield out.batch()

    return rows.select("anchor", "tid", "first", "body").mapInArrow(run, PLACE + (", body binary" if bodies else ""))


# -- marks ------------------------------------------------------------------------------

MARKS = "tid binary, first int, stop int"
# (values, starts of windows, initial groups) -> windows in a group of two or more
Counter = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def marks_of_strings(texts: DataFrame, w: Windows, repeated: Counter, label: str) -> DataFrame:
    """Runs of windows [first, stop) of the texts that are repeated.

    Each round counts strings of a bucket by name. Those at several places are marked there;
    where a bucket has different strings, or a run, one place of each goes to the bucket's task,
    or, from a bucket of more than BUCKET strings, to the next round.
    """
    made = partial(strings, texts, w)
    found: list[DataFrame] = []
    while True:
        places = staged(made(False), f"{label}-places")
        by_name = places.groupBy("anchor", "name").agg(
            F.count("*").alias("n"), F.min(F.struct("tid", "first")).alias("one"), F.first("count").alias("count")
        )
        buckets = by_name.groupBy("anchor").agg(F.count("*").alias("m"))
        known = by_name.join(buckets, "anchor").where((F.col("n") > 1) | (F.col("m") > 1) | (F.col("count") > w.most))
        known = staged(known.select("anchor", "name", "n", "m", "one"), f"{label}-names")
        several = known.where("n > 1").select("anchor", "name")
        stop = (F.col("first") + F.col("count")).alias("stop")
        found.append(places.join(several, ["anchor", "name"]).select("tid", "first", stop))
        # strings of a bucket of whole windows are equal, or runs of one unit in different lengths
        large = (F.col("m") > BUCKET) & F.lit(w.gram < w.length)
        ones = known.where((F.col("m") > 1) | (F.col("n") == 1)).select("one.tid", "one.first", large.alias("large"))
        ones = made(True).join(ones, ["tid", "first"]).select("anchor", "tid", "first", "body", "large")
        again = not known.where(large).isEmpty()
        if again:
            ones = staged(ones, f"{label}-strings")
        found.append(bucket_marks(ones.where("not large").drop("large"), w, repeated))
        if not again:
            break
        w = w.next
        made = partial(dealt_again, ones.where("large"), w)
    return reduce(DataFrame.unionByName, found)


def bucket_marks(packed: DataFrame, w: Windows, repeated: Counter) -> DataFrame:
    """Runs of windows [first, stop) that are repeated, found within each anchor's bucket.

    Equal strings of a bucket are taken once: two of them repeat all their windows. Only
    buckets with different strings, or with a run, go through `repeated`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for batch in batches:
            rows = list(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
            waiting += rows
            if len(waiting) >= 4096:
                # the last bucket may go on in the next batch
                last = waiting[-1][0]
                cut = len(waiting)
                while cut and waiting[cut - 1][0] == last:
                    cut -= 1
                if cut:
                    yield from marks_of(waiting[:cut], w, repeated)
                    waiting = waiting[cut:]
        if waiting:
            yield from marks_of(waiting, w, repeated)

    return packed.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, MARKS)


def marks_of(rows: list[tuple], w: Windows, repeated: Counter) -> Iterator[pa.RecordBatch]:
    members: dict[tuple, list[tuple]] = {}
    for anchor, tid, first, body in rows:
        members.setdefault((anchor, body), []).append((tid, first))
    variants: dict[int, list[tuple]] = {}
    for key in members:
        variants.setdefault(key[0], []).append(key)
    out: list[tuple] = []
    todo: list[tuple] = []  # (key, members) of buckets with several strings or a run
    size = 0
    for keys in variants.values():
        if len(keys) == 1:
            n = windows_in(keys[0][1], w)
            if len(members[keys[0]]) > 1:
                out += [(tid, first, first + n) for tid, first in members[keys[0]]]
                continue
            if n <= w.most:
                continue
        todo += [(k, members[k]) for k in keys]
        size += sum(len(k[1]) for k in keys)
        if size > SORT_WINDOWS:
            out += sorted_marks(todo, w, repeated)
            todo, size = [], 0
    if todo:
        out += sorted_marks(todo, w, repeated)
    columns = list(zip(*out, strict=True)) if out else [(), (), ()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())],
        names=["tid", "first", "stop"],
    )


def windows_in(body: bytes, w: Windows) -> int:
    return (body.count(b" ") + 1 if w.unit == "word" else len(body)) - w.length + 1


def sorted_marks(todo: list[tuple], w: Windows, repeated: Counter) -> list[tuple]:
    """Marks of strings that share buckets: windows of one bucket start in one group, and
    `repeated` tells which are still grouped over their length."""
    if w.unit == "word":
        lists = [k[1].split(b" ") for k, _ in todo]
        flat = [x for words in lists for x in words]
        numbers: dict[bytes, int] = {}
        values = np.array([numbers.setdefault(x, len(numbers)) for x in flat], np.uint64)
        lengths = np.array([len(x) for x in lists])
    else:
        values = np.frombuffer(b"".join(k[1] for k, _ in todo), np.uint8)
        lengths = np.array([len(k[1]) for k, _ in todo])
    begin = np.cumsum(lengths) - lengths
    count = lengths - w.length + 1
    string = np.repeat(np.arange(len(todo)), count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    bucket = np.unique(np.array([k[0] for k, _ in todo], np.int64), return_inverse=True)[1]
    hit = repeated(values, begin[string] + inside, bucket[string])
    # a string held by several rows repeats all its windows
    hit |= (np.array([len(m) for _, m in todo]) > 1)[string]
    edge = np.flatnonzero(hit)
    if not len(edge):
        return []
    new = np.flatnonzero(np.concatenate(([True], (edge[1:] != edge[:-1] + 1) | (string[edge[1:]] != string[edge[:-1]]))))
    last = np.concatenate((edge[new[1:] - 1], edge[-1:]))
    return [
        (tid, first + int(inside[a]), first + int(inside[b]) + 1)
        for a, b in zip(edge[new], last, strict=True)
        for tid, first in todo[string[a]][1]
    ]


# -- results ----------------------------------------------------------------------------


def spans_of(marks: DataFrame, w: Windows) -> DataFrame:
    """(tid, spans): units covered by repeated windows, as marks sorted by their start."""
    return marks.groupBy("tid").agg(
        F.sort_array(F.collect_list(F.struct("first", (F.col("stop") + (w.length - 1)).alias("stop")))).alias("spans")
    )


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs; spans that touch are one."""
    out: list[list[int]] = []
    for s in spans:
        if out and s["first"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["stop"])
        else:
            out.append([s["first"], s["stop"]])
    return [(a, b) for a, b in out]


def cut_texts(texts: DataFrame, w: Windows) -> DataFrame:
    """(tid, n_removed, n_spans, spans, kept) of texts with their marked spans."""
    schema = "tid binary, n_removed long, n_spans long, spans array<struct<first:long,stop:long>>, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_spans(batch.column(1))
            out: list[tuple] = []
            for i, tid in enumerate(batch.column(0).to_pylist()):
                part = raw[offsets[i] : offsets[i + 1]].tobytes()
                units = part.split() if w.unit == "word" else part
                runs = merged(batch.column(2)[i].as_py())
                keep, at = [], 0
                for a, b in [*runs, (len(units), len(units))]:
                    keep += units[at:a] if w.unit == "word" else [units[at:a]]
                    at = b
                kept = (b" " if w.unit == "word" else b"").join(keep)
                out.append((tid, sum(b - a for a, b in runs), len(runs), [{"first": a, "stop": b} for a, b in runs], kept))
            c = list(zip(*out, strict=True)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(c[0], pa.binary()),
                    pa.array(c[1], pa.int64()),
                    pa.array(c[2], pa.int64()),
                    pa.array(c[3], pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))),
                    pa.array(c[4], pa.binary()),
                ],
                names=["tid", "n_removed", "n_spans", "spans", "kept"],
            )

    return texts.mapInArrow(run, schema)


def remove_repeats(df: DataFrame, keep: list[str], text_col: str, w: Windows, repeated: Counter, label: str) -> DataFrame:
    """Per row of `df`: `keep` (the id first), tid, n_units, n_removed, n_spans, sha, kept, spans.

    `kept` (binary) and its digest `sha` hold what is left; `kept` is null where nothing is
    removed, and then the row's text is whole. `spans` are the maximal removed runs, n_spans
    their number; they are null also where all goes because the whole text is repeated.
    """
    rows = staged(profile(df, keep, text_col, w), f"{label}-profile")
    texts = staged(candidate_texts(df, keep[0], text_col, rows, w), f"{label}-texts")
    marks = marks_of_strings(texts, w, repeated, label)
    alone = texts.where("copies = 1").select("tid", "text")
    spanned = alone.join(spans_of(marks, w), "tid").select("tid", "text", "spans")
    cuts = cut_texts(spanned, w).withColumn("cut_sha", F.sha2("kept", 256))
    copies = rows.groupBy("tid").agg(F.count("*").alias("copies"))
    several = (F.col("copies") > 1) & (F.col("units") >= w.length)
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return (
        rows.drop("segments")
        .join(copies.where("copies > 1"), "tid", "left")
        .join(cuts, "tid", "left")
        .select(
            *keep,
            "tid",
            F.col("units").alias("n_units"),
            F.when(several, F.col("units")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(several, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0))).alias("n_spans"),
            F.when(several, empty).otherwise(F.coalesce("cut_sha", "sha")).alias("sha"),
            F.when(several, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
            F.when(~several | several.isNull(), F.col("spans")).alias("spans"),
        )
    )

