"""Repair of conversation structure: the cheapest edits that make turns alternate.

The roles of a conversation shall read as nothing, or as an optional system turn and then pairs
of user and assistant. Four states follow that pattern (start, behind system, behind user,
behind assistant), and each determines the role that may come next. A turn is kept for 0, gets the role
that is due for 3 or goes for 4; a turn of the due role is inserted for 3. Blank turns and
repetitions have to go; a truncated turn that stays adds 3. Of the cheapest edits those are taken
whose initials (Delete, Insert, Keep, Rerole), one letter an edit in order, are the least by ASCII.

*Hirschberg's method.* Costs of reaching each state form a vector of four, from the front and
from the back. In the middle of the turns the two are added up; a state with the least sum lies
on a cheapest path, both halves are solved alone with it as end and start, and no table of turns by states
is kept. Where several states have the least sum, the audit-least one is the state whose own
prefix is the least. That needs no text: prefixes that end with the same turn's edit hold one
edit per turn besides insertions, so none of them begins another, and their order after a turn follows from their order
before it. A forward vector therefore carries the order of its states beside their costs.

*On Spark* the same crossing works between tasks. Turns are dealt by range of (conversation,
turn), so a very long conversation lies in several tasks. Each task sums up its piece as the
four forward vectors from the four possible states before it. Those summaries (one row per conversation and task) are added up per conversation, which settles the states between
pieces; then every piece is solved by halves on its own. Up to here rows hold digests instead of
texts, and copies of a turn are one row with a number. Only the digest of a repaired conversation
needs its texts in order, in one task; they stream through it.

Order of turns: by turn (nulls first), then role, then MD5 of the text. Nulls of role and text
count as one space, a null conversation is one of its own, repeated rows are repetitions. Of no rows come no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import staged

START, SYSTEM, USER, ASSISTANT = STATES = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
FAR = 1 << 40  # more than any cost that matters between states
LARGEST = (1 << 63) - 1
#: Code of a turn: 2 * (s, u, a or other) + truncated; or one that has to go.
MUST_GO = 8
SPACES = " \t\n\x0b\x0c\r"


def due(state: int) -> int:
    """The state after a turn of the role that is due."""
    return ASSISTANT if state == USER else USER


def edits_of_turn(code: int) -> list[dict[int, tuple[int, str]]]:
    """Per state before a turn: state after it -> the cheapest edits (cost, initials), the least
    of equals. Insertions stand before the turn's own edit."""
    table: list[dict[int, tuple[int, str]]] = []
    late = 0 if code == MUST_GO else TRUNCATED * (code % 2)
    for before in STATES:
        found: dict[int, tuple[int, str]] = {}
        state = before
        for inserted in range(3):
            options = [(state, DELETE, "D")]
            if code != MUST_GO:
                after = {START: SYSTEM if state == START else None, 1: USER if state != USER else None, 2: ASSISTANT if state == USER else None}
                kept = after.get(code // 2)
                options += [(due(state), REROLE + late, "R")] + ([(kept, KEEP + late, "K")] if kept is not None else [])
            for end, cost, letter in options:
                here = (INSERT * inserted + cost, "I" * inserted + letter)
                found[end] = min(found.get(end, here), here)
            state = due(state)
        table.append(found)
    return table


TABLES = [edits_of_turn(code) for code in range(MUST_GO + 1)]
#: Insertions that end the pattern behind each state.
TAIL = (0, 2, 1, 0)

# A forward vector: costs above the least one by state, and the states in the order of prefixes.
Vector = tuple[tuple[int, ...], tuple[int, ...]]


def begin(state: int) -> Vector:
    return tuple(0 if s == state else FAR for s in STATES), (state,)


@lru_cache(maxsize=1 << 16)
def forward(vector: Vector, code: int) -> tuple[int, Vector]:
    """The vector after one more turn, and what the least cost grew by."""
    costs, order = vector
    best: dict[int, tuple[int, int, str]] = {}
    for place, before in enumerate(order):
        for after, (cost, text) in TABLES[code][before].items():
            here = (costs[before] + cost, place, text)
            best[after] = min(best.get(after, here), here)
    least = min(b[0] for b in best.values())
    return least, (
        tuple(best[s][0] - least if s in best else FAR for s in STATES),
        tuple(sorted(best, key=lambda s: best[s][1:])),
    )


@lru_cache(maxsize=1 << 16)
def backward(costs: tuple[int, ...], code: int) -> tuple[int, ...]:
    """Costs up to a fixed end from each state before one more turn, above the least."""
    new = [min((cost + costs[after] for after, (cost, _) in TABLES[code][before].items()), default=FAR) for before in STATES]
    least = min(new)
    return tuple(min(c - least, FAR) for c in new)


# Steps are (code, times): `times` turns that have to go count as one step.
Step = tuple[int, int]


def crossed(steps: list[Step], state: int) -> tuple[int, Vector]:
    """Least cost and forward vector over the steps from one state."""
    total, vector = 0, begin(state)
    for code, times in steps:
        least, vector = forward(vector, code)
        total += least + DELETE * (times - 1)
    return total, vector


def solve(steps: list[Step], start: int, end: int) -> list[str]:
    """Initials per step of the cheapest edits from state to state, the least of equals."""
    out: list[str] = [""] * len(steps)
    todo = [(0, len(steps), start, end)]
    while todo:
        lo, hi, first, last = todo.pop()
        if hi - lo == 1:
            code, times = steps[lo]
            out[lo] = "D" * (times - 1) + TABLES[code][first][last][1]
            continue
        mid = (lo + hi) // 2
        vector = begin(first)
        for code, _ in steps[lo:mid]:
            vector = forward(vector, code)[1]
        costs = begin(last)[0]
        for code, _ in reversed(steps[mid:hi]):
            costs = backward(costs, code)
        ahead, order = vector
        cross = min(order, key=lambda s: (ahead[s] + costs[s], order.index(s)))
        todo += [(lo, mid, first, cross), (mid, hi, cross, last)]
    return out


def steps_of(code: int, copies: int) -> list[Step]:
    """A turn and its copies, all of which have to go but the first."""
    if code == MUST_GO:
        return [(MUST_GO, copies)]
    return [(code, 1)] + ([(MUST_GO, copies - 1)] if copies > 1 else [])


# -- turns ------------------------------------------------------------------------------


def turns(rows: DataFrame, conv: str, turn: str, role: str, text: str, copies: Column | None = None) -> DataFrame:
    """(conv, turn, role, digest, text, n): `n` copies of a turn, none where it is 0."""
    filled = F.coalesce(rows[text].cast("string"), F.lit(" "))
    return rows.select(
        rows[conv].alias("conv"),
        rows[turn].cast("long").alias("turn"),
        F.coalesce(rows[role].cast("string"), F.lit(" ")).alias("role"),
        filled.alias("text"),
        (F.lit(1) if copies is None else copies).cast("long").alias("n"),
    ).withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns of which a hash of conversation and turn drops, empties, cuts, repeats or reroles some."""
    space = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(rows[conv].cast("string"), space), F.coalesce(rows[turn].cast("string"), space))
    fault = F.col("fault")
    plain = rows.select(
        rows[conv].alias("conv"),
        rows[turn].alias("turn"),
        F.coalesce(rows[role].cast("string"), space).alias("role"),
        F.coalesce(rows[text].cast("string"), space).alias("text"),
        (F.crc32(name.cast("binary")) % 20).alias("fault"),
    )
    whole = F.col("text")
    hurt = plain.select(
        "conv",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(whole, ".!?", "")).otherwise(whole).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("n"),
    )
    return turns(hurt, "conv", "turn", "role", "text", F.col("n"))


def distinct_turns(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, initial, n, code): copies as one row; the code takes the first
    fault of the first copy. Repetitions of earlier turns are found by a grouping and a join."""
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(end == "", "blank").when(F.right(end, F.lit(1)).isin(".", "!", "?"), "none").otherwise("truncated")
    slim = (
        rows.where("n > 0")
        .select("conv", "turn", "role", "digest", "n", fault.alias("fault"))
        .groupBy("conv", "turn", "role", "digest", "fault")
        .agg(F.sum("n").alias("n"))
    )
    slim = staged(slim, "repair-turns")
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = slim.groupBy("conv", "role", "digest").agg(F.min(when).alias("first"))
    first = first.select(F.col("conv").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), F.col("first.turn").alias("_t"))
    same = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d"))
    initial = F.left("role", F.lit(1))
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when((F.col("fault") != "blank") & ~F.col("turn").eqNullSafe(F.col("_t")), "duplicate").otherwise(F.col("fault"))
    return slim.join(first, same).select(
        "conv",
        "turn",
        "role",
        "digest",
        initial.alias("initial"),
        "n",
        fault.alias("fault"),
        F.when(fault.isin("blank", "duplicate"), MUST_GO).otherwise(2 * kind + (fault == "truncated").cast("int")).alias("code"),
    )


# -- pieces -----------------------------------------------------------------------------


def batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def by_conversation(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[tuple[bool, dict]]:
    """Rows of sorted batches as (first of its key, row)."""
    last: tuple | None = None
    for b in batches:
        names = b.schema.names
        for values in zip(*(c.to_pylist() for c in b.columns), strict=True):
            row = dict(zip(names, values, strict=True))
            mine = tuple(row[k] for k in key)
            yield mine != last, row
            last = mine


class Piece:
    """What a task's rows of one conversation add up to."""

    def __init__(self, conv) -> None:
        self.conv, self.vectors = conv, [(0, begin(s)) for s in STATES]
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.first = self.last = self.low = self.high = None

    def add(self, row: dict) -> None:
        for code, times in steps_of(row["code"], row["n"]):
            for s in STATES:
                total, vector = self.vectors[s]
                least, vector = forward(vector, code)
                self.vectors[s] = (total + least + DELETE * (times - 1), vector)
        c, copies = self.counts, row["n"] - 1
        if row["fault"] in ("blank", "duplicate"):
            c[row["fault"]] += row["n"]
        else:
            c["truncated"] += row["fault"] == "truncated"
            c["duplicate"] += copies
        c["illegal"] += copies + (self.last is not None and not legal(self.last, row["initial"]))
        c["turns"] += row["turn"] is not None and row["turn"] != self.high
        if row["turn"] is not None:
            self.low = row["turn"] if self.low is None else self.low
            self.high = row["turn"]
        self.first, self.last = row["initial"] if self.first is None else self.first, row["initial"]

    def summary(self) -> dict:
        costs = [t + c if c < FAR else -1 for t, (costs, _) in self.vectors for c in costs]
        order = [s for _, (_, states) in self.vectors for s in (*states, *(-1,) * (4 - len(states)))]
        return {"conv": self.conv, "costs": costs, "order": order, **self.counts, "first": self.first, "last": self.last, "low": self.low, "high": self.high}


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


ROW = "conv {conv}, turn long, role string, digest binary, n long, code int, seq long"
SUMMARY = (
    "costs array<long>, order array<int>, blank long, duplicate long, truncated long, illegal long, turns long, "
    "first string, last string, low long, high long"
)


def pieces(rows: DataFrame, conv_type: pa.DataType) -> DataFrame:
    """Turns dealt by range and numbered by task, each piece of a conversation followed by a row
    with its summary (`n` null)."""
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "digest")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    kinds = {
        "conv": conv_type, "turn": pa.int64(), "role": pa.string(), "digest": pa.binary(), "n": pa.int64(), "code": pa.int32(), "seq": pa.int64(), "part": pa.int32(),
        "costs": pa.list_(pa.int64()), "order": pa.list_(pa.int32()), "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(),
        "illegal": pa.int64(), "turns": pa.int64(), "first": pa.string(), "last": pa.string(), "low": pa.int64(), "high": pa.int64(),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        piece, part, seq = None, 0, 0

        def emitted() -> pa.RecordBatch:
            made = batch({k: ([r.get(k) for r in out], t) for k, t in kinds.items()})
            out.clear()
            return made

        for new, row in by_conversation(batches, ("conv",)):
            if new and piece:
                out.append({**piece.summary(), "part": part, "seq": seq})
            if new:
                piece = Piece(row["conv"])
            piece.add(row)
            part, seq = row["part"], seq + 1
            out.append({**{k: row[k] for k in ("conv", "turn", "role", "digest", "n", "code", "part")}, "seq": seq})
            if len(out) >= 4096:
                yield emitted()
        if piece:
            out.append({**piece.summary(), "part": part, "seq": seq})
        yield emitted()

    kind = rows.schema["conv"].dataType.simpleString()
    return ranged.mapInArrow(run, f"{ROW.format(conv=kind)}, part int, {SUMMARY}")


def crossings(summaries: DataFrame, conv_type: pa.DataType) -> DataFrame:
    """Per piece its states before and after and the insertions behind it; and per conversation
    (`part` null) its figures. A conversation has at most one summary per task."""
    kinds = {
        "conv": conv_type, "part": pa.int32(), "start": pa.int32(), "stop": pa.int32(), "tail": pa.int32(),
        **dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), pa.int64()),
    }

    def settled(found: list[dict]) -> Iterator[dict]:
        costs, order, back = {START: 0}, [START], []
        for piece in found:
            best: dict[int, tuple] = {}
            for place, before in enumerate(order):
                row, ranks = piece["costs"][4 * before : 4 * before + 4], piece["order"][4 * before : 4 * before + 4]
                for rank, after in enumerate(ranks):
                    if after >= 0:
                        here = (costs[before] + row[after], place, rank, before)
                        best[after] = min(best.get(after, here), here)
            order = sorted(best, key=lambda s: best[s][1:3])
            costs = {s: b[0] for s, b in best.items()}
            back.append({s: b[3] for s, b in best.items()})
        state = min(order, key=lambda s: (costs[s] + INSERT * TAIL[s], order.index(s)))
        total, tail = costs[state] + INSERT * TAIL[state], TAIL[state]
        for piece, before in zip(reversed(found), reversed(back), strict=True):
            yield {"conv": piece["conv"], "part": piece["part"], "start": before[state], "stop": state, "tail": tail}
            state, tail = before[state], 0
        figures = {k: sum(p[k] for p in found) for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
        for a, b in zip(found, found[1:], strict=False):
            figures["illegal"] += not legal(a["last"], b["first"])
        known = [p for p in found if p["high"] is not None]
        for a, b in zip(known, known[1:], strict=False):
            figures["turns"] -= a["high"] == b["low"]
        gaps = min(known[-1]["high"] - known[0]["low"] + 1 - figures["turns"], LARGEST) if known else 0
        yield {"conv": found[0]["conv"], "gaps": gaps, "cost": total, **{k: v for k, v in figures.items() if k != "turns"}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[dict] = []
        out: list[dict] = []
        for new, row in by_conversation(batches, ("conv",)):
            if new and found:
                out += settled(found)
                found = []
            found.append(row)
            if len(out) >= 4096:
                yield batch({k: ([r.get(k) for r in out], t) for k, t in kinds.items()})
                out = []
        out += settled(found) if found else []
        yield batch({k: ([r.get(k) for r in out], t) for k, t in kinds.items()})

    kind = summaries.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, part int, start int, stop int, tail int, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    fields = ("conv", "part", *(f.split(" ")[0] for f in SUMMARY.split(", ")))
    return summaries.select(*fields).repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "part").mapInArrow(run, schema)


def decisions(rows: DataFrame, crossed_at: DataFrame, conv_type: pa.DataType) -> DataFrame:
    """(conv, turn, role, digest, edits): each piece solved by halves between its two states. The
    edits of a turn are insertions before it, its own, those of its copies, and at the end insertions
    behind it."""
    none = {c: F.lit(None) for c in ("turn", "role", "digest", "n", "code")}
    heads = crossed_at.where("part is not null").select(
        "conv", "part", F.lit(0).cast("long").alias("seq"), "start", "stop", "tail", *(v.alias(k) for k, v in none.items())
    )
    bodies = rows.select("conv", "part", "seq", *(F.lit(None).cast("int").alias(c) for c in ("start", "stop", "tail")), *none)
    kinds = {"conv": conv_type, "turn": pa.int64(), "role": pa.string(), "digest": pa.binary(), "edits": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: dict = {}
        mine: list[dict] = []
        out: list[dict] = []

        def solved() -> None:
            each = [steps_of(r["code"], r["n"]) for r in mine]
            found = iter(solve([s for steps in each for s in steps], head["start"], head["stop"]))
            for row, steps in zip(mine, each, strict=True):
                row["edits"] = "".join(next(found) for _ in steps)
            mine[-1]["edits"] += "I" * head["tail"]
            out.extend(mine)

        for _, row in by_conversation(batches, ("part", "conv")):
            if row["n"] is None:
                if mine:
                    solved()
                    mine = []
                head = row
            else:
                mine.append(row)
            if len(out) >= 4096:
                yield batch({k: ([r[k] for r in out], t) for k, t in kinds.items()})
                out = []
        if mine:
            solved()
        yield batch({k: ([r[k] for r in out], t) for k, t in kinds.items()})

    kind = rows.schema["conv"].dataType.simpleString()
    together = bodies.unionByName(heads)
    dealt = together.repartition("part").sortWithinPartitions("part", F.col("conv").asc_nulls_first(), "seq")
    return dealt.mapInArrow(run, f"conv {kind}, turn long, role string, digest binary, edits string")


def plan_repairs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of `turns`: the edits of each distinct turn, and the figures of each conversation with turns."""
    distinct = distinct_turns(rows)
    conv_type = distinct.select("conv").limit(0).toArrow().schema.field(0).type
    dealt = staged(pieces(distinct, conv_type), "repair-pieces")
    crossed_at = staged(crossings(dealt.where("n is null"), conv_type), "repair-crossings")
    edits = decisions(dealt.where("n is not null"), crossed_at, conv_type)
    return edits, crossed_at.where("part is null").drop("part", "start", "stop", "tail")


# -- repaired conversations -------------------------------------------------------------

# Turns that a task remembers as just passed on; copies of them are left out before the shuffle.
REMEMBERED = 1 << 14


def once(rows: DataFrame) -> DataFrame:
    """Turns without the copies that a task meets again soon; any that remain are left out later."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, None] = {}
        for b in batches:
            keep = []
            for key in zip(*(b.column(c).to_pylist() for c in ("conv", "turn", "role", "digest")), strict=True):
                keep.append(key not in seen)
                seen[key] = None
                if len(seen) > REMEMBERED:
                    del seen[next(iter(seen))]
            yield b.filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, rows.schema)


def repaired(rows: DataFrame, edits: DataFrame, figures: DataFrame) -> DataFrame:
    """One row per conversation of `rows`: its figures, audit, and the SHA-256 of the repaired turns as
    `role:text`, one a line."""
    conv_type = rows.select("conv").limit(0).toArrow().schema.field(0).type
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    every = rows.select("conv").distinct().select("conv", F.lit(0).alias("kind"))
    parts = [
        every,
        figures.select("conv", F.lit(1).alias("kind"), *counts),
        edits.select("conv", F.lit(2).alias("kind"), "turn", "role", "digest", "edits"),
        once(rows.where("n > 0").select("conv", "turn", "role", "digest", "text")).withColumn("kind", F.lit(3)),
    ]
    together = parts[0]
    for p in parts[1:]:
        together = together.unionByName(p, allowMissingColumns=True)
    keys = [F.col(c).asc_nulls_first() for c in ("conv", "body", "turn", "role", "digest", "kind")]
    dealt = together.withColumn("body", F.col("kind") > 1).repartition("conv").sortWithinPartitions(*keys)
    kinds = {"conv": conv_type, **dict.fromkeys(counts, pa.int64()), "audit": pa.string(), "repaired_sha256": pa.string()}
    names = {USER: "user", ASSISTANT: "assistant"}

    class Conversation:
        def __init__(self, conv) -> None:
            self.out = {"conv": conv, **dict.fromkeys(counts, 0)}
            self.audit: list[str] = []
            self.digest, self.state, self.left, self.lines = hashlib.sha256(), START, "", 0

        def line(self, role: str, text: str) -> None:
            self.digest.update(("\n" if self.lines else "").encode() + f"{role}:{text}".encode())
            self.lines += 1

        def follow(self, edits: str, row: dict | None) -> str:
            """Carries out edits; up to one that needs the turn's text where that is not there yet."""
            for i, edit in enumerate(edits):
                if edit == "D":
                    continue
                if edit != "I" and row is None:
                    return edits[i:]
                after = SYSTEM if edit == "K" and row["role"].startswith("s") else due(self.state)
                self.line(row["role"] if edit == "K" else names[after], "" if edit == "I" else row["text"])
                self.state = after
            return ""

        def add(self, row: dict) -> None:
            if row["kind"] == 1:
                self.out |= {c: row[c] for c in counts}
            elif row["kind"] == 2:
                self.audit.append(row["edits"])
                self.left = self.follow(row["edits"], None)
            elif row["kind"] == 3 and self.left:
                self.left = self.follow(self.left, row)

        def ended(self) -> dict:
            return {**self.out, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for new, row in by_conversation(batches, ("conv",)):
            if new:
                if now:
                    out.append(now.ended())
                now = Conversation(row["conv"])
            now.add(row)
            if len(out) >= 1024:
                yield batch({k: ([r[k] for r in out], t) for k, t in kinds.items()})
                out = []
        if now:
            out.append(now.ended())
        yield batch({k: ([r[k] for r in out], t) for k, t in kinds.items()})

    kind = rows.schema["conv"].dataType.simpleString()
    figures_schema = ", ".join(f"{c} long" for c in counts)
    return dealt.mapInArrow(run, f"conv {kind}, {figures_schema}, audit string, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations of `turns`."""
    return repaired(rows, *plan_repairs(rows))
