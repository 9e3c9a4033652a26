"""Mixing sources to target weights by min-cost flow.

A document can belong to several sources. Documents are summed by membership pattern (the
set of their sources); a flow routes each pattern's capacity to the quotas of its sources,
where reading a pattern again costs more with every repetition (convex costs), so nothing is
repeated while anything unread can serve. Documents are then chosen in a seeded order until
a pattern's flow is met.

Where every pattern is one source, a pattern's flow is its source's target, which sums over
the ordered sources give without a solver; sources may then be as many as web domains. Where
patterns overlap, the flow is solved on the driver, with one row per pattern: its work grows
with the square of their number, so more than `most_patterns` of them are refused.

Targets: sources in order of code points, null last, have the given weights in turn and
share `total_share` of all sizes; a target stops at `most_copies` times its source's size
and the excess is shared anew by weight until none is above.

Choosing is distributed: documents are ordered by a digest of id and text, rows that agree in
both are one entry with their number, and the digest deals a pattern's entries into ranges
whose sums give each range its starting point. So no range is large, whatever the share of a
source, an id or a text, and reruns agree however rows are dealt. A document is taken when
that brings its source nearer to its flow; each copy of it counts with its size.

Null text has size 0 and is never taken; a null source is a source. Repeated rows are taken
each on their own. An empty table gives no rows. Extra columns do not matter.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import staged

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MOST_COPIES = 2
# Documents per range of the order digest, on average.
RANGE_ROWS = 4096
# Overlapping patterns that the solver on the driver takes.
MOST_PATTERNS = 2000


def water_fill(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Targets in proportion to the weights, none above `most` times its size."""
    caps = [most * s for s in sizes]
    # sources fill up in order of cap / weight; what is left is shared by the others
    order = sorted(range(len(sizes)), key=lambda i: (caps[i] / weights[i], i))
    rest, left = float(total), sum(weights)
    out = [0.0] * len(sizes)
    for place, i in enumerate(order):
        if caps[i] * left > rest * weights[i]:
            level = rest / left
            for j in order[place:]:
                out[j] = level * weights[j]
            return out
        out[i] = caps[i]
        rest -= caps[i]
        left -= weights[i]
    return out


class Flow:
    """Min-cost flow by successive shortest paths with potentials."""

    def __init__(self, nodes: int) -> None:
        self.graph: list[list[list]] = [[] for _ in range(nodes)]

    def edge(self, a: int, b: int, capacity: int, cost: int) -> list:
        forward = [b, capacity, cost, len(self.graph[b])]
        self.graph[a].append(forward)
        self.graph[b].append([a, 0, -cost, len(self.graph[a]) - 1])
        return forward

    def run(self, source: int, sink: int) -> None:
        n = len(self.graph)
        potential = [0] * n
        while True:
            distance, before = [math.inf] * n, [None] * n
            distance[source] = 0
            heap = [(0, source)]
            while heap:
                d, a = heapq.heappop(heap)
                if d > distance[a]:
                    continue
                for e in self.graph[a]:
                    if e[1] > 0 and d + e[2] + potential[a] - potential[e[0]] < distance[e[0]]:
                        distance[e[0]] = d + e[2] + potential[a] - potential[e[0]]
                        before[e[0]] = (a, e)
                        heapq.heappush(heap, (distance[e[0]], e[0]))
            if before[sink] is None:
                return
            potential = [p + d if d < math.inf else p for p, d in zip(potential, distance, strict=True)]
            amount, at = math.inf, sink
            while at != source:
                amount = min(amount, before[at][1][1])
                at = before[at][0]
            at = sink
            while at != source:
                a, e = before[at]
                e[1] -= amount
                self.graph[at][e[3]][1] += amount
                at = a


def route(patterns: list[tuple[tuple[int, ...], int]], quotas: list[int], most: int) -> list[dict[int, int]]:
    """For each pattern (its sources, its size), the flow to each of its sources."""
    flow = Flow(len(patterns) + len(quotas) + 2)
    source, sink = len(patterns) + len(quotas), len(patterns) + len(quotas) + 1
    edges: list[dict[int, tuple[list, int]]] = []
    for p, (members, size) in enumerate(patterns):
        for copy in range(most):
            flow.edge(source, p, size, 2 * copy + 1)
        # no source can get more of a pattern than all its copies
        edges.append({s: (flow.edge(p, len(patterns) + s, most * size, 0), most * size) for s in members})
    for s, quota in enumerate(quotas):
        flow.edge(len(patterns) + s, sink, quota, 0)
    flow.run(source, sink)
    return [{s: whole - e[1] for s, (e, whole) in chosen.items()} for chosen in edges]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def order_digest(seed: int, id_col: Column, text: Column) -> Column:
    """Sort key of a document in the seeded order: the same text in other engines too."""
    words = (F.coalesce(c.cast("string"), F.lit("")) for c in (id_col, text))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *words).cast("binary"))


def mix(
    df: DataFrame,
    id_col: str,
    sources: Column,
    text_col: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most_copies: int = MOST_COPIES,
    seed: int = 17,
    keep: tuple[str, ...] = (),
    most_patterns: int = MOST_PATTERNS,
) -> tuple[DataFrame, DataFrame]:
    """Per entry (rows equal in all of this): id, `keep`, sources, size, taken (words of one
    row that the mix takes, copies counted) and `rows`, the number of rows it stands for;
    and per source: source, source_size, target. `common.one_row_each` writes the rows out.

    `sources` is an array of the row's source names; null elements are a source. `keep` names
    columns that follow from id and text.
    """
    entries = staged(
        df.select(
            df[id_col].alias("id"),
            *(df[c].alias(c) for c in keep),
            F.sort_array(F.array_distinct(sources)).alias("sources"),
            word_count(df[text_col]).alias("size"),
            order_digest(seed, df[id_col], df[text_col]).alias("digest"),
        )
        .groupBy("id", *keep, "sources", "size", "digest")
        .agg(F.count("*").alias("rows")),
        "mixing",
    )
    patterns = entries.groupBy("sources").agg(F.sum(F.col("size") * F.col("rows")).alias("pattern_size"), F.count("*").alias("n"))
    patterns = staged(patterns, "mixing-patterns")
    if patterns.where(F.size("sources") != 1).isEmpty():
        table = staged(separate(patterns, weights, total_share, most_copies), "mixing-targets")
        per_source = table.select(F.col("sources")[0].alias("source"), F.col("pattern_size").alias("source_size"), "target")
        table = table.withColumn("flow", F.rint("target").cast("long"))
    else:
        table, per_source = overlapping(patterns, weights, total_share, most_copies, most_patterns)
    table = table.select("sources", "pattern_size", "flow", F.greatest(F.lit(1), F.expr(f"n div {RANGE_ROWS}")).alias("ranges"))
    ranged = entries.join(table, "sources").withColumn(
        "range", F.floor(F.conv(F.substring("digest", 1, 8), 16, 10).cast("double") / 4294967296.0 * F.col("ranges")).cast("long")
    )
    words = F.col("size") * F.col("rows")
    sums = ranged.groupBy("sources", "range").agg(F.sum(words).alias("sum"))
    # one row per range: small, and dealt by pattern
    before = Window.partitionBy("sources").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("sources", "range", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("sources", "range").orderBy("digest", "id").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumn("upto", F.sum(words).over(inside)).join(starts, ["sources", "range"])
    # Copy c of the pattern covers [c * pattern_size, (c + 1) * pattern_size) of the flow, and
    # row j of an entry ends j sizes into the entry; a row counts where its middle lies within
    # the flow, which holds for the first `reach` rows.
    placed = placed.withColumn("begin", F.col("base") + F.col("upto") - words)
    reach = [
        F.expr(
            f"if(size = 0, 0L, greatest(0L, least(rows, (2 * flow + size - 2 * ({c} * pattern_size + begin)) div (2 * greatest(size, 1L)))))"
        )
        for c in range(most_copies)
    ]
    fewer = [F.col("rows"), *reach, F.lit(0)]
    levels = F.array(
        *(F.struct(F.lit(c).cast("long").alias("copies"), (fewer[c] - fewer[c + 1]).cast("long").alias("n")) for c in range(most_copies + 1))
    )
    level = placed.withColumn("level", F.explode(levels)).where("level.n > 0")
    return level.select("id", *keep, "sources", "size", (F.col("level.copies") * F.col("size")).alias("taken"), F.col("level.n").alias("rows")), per_source


def separate(patterns: DataFrame, weights: tuple[float, ...], total_share: float, most: int) -> DataFrame:
    """`target` of patterns of one source each.

    Sources fill up in order of cap over weight. Going through them in that order, what is
    left of words and weights is a running sum; the first source that its share does not fill
    sets the level of all from there on."""
    name = F.col("sources")[0]
    ordered = running(patterns, [name.isNull(), name], {"place": F.lit(1).cast("long")}, "mixing-names")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = ordered.withColumn("weight", weight).withColumn("cap", most * F.col("pattern_size").cast("double"))
    turn = [F.col("cap") / F.col("weight"), F.col("place")]
    filled = running(sources, turn, {"words": F.col("cap"), "parts": F.col("weight"), "turn": F.lit(1).cast("long")}, "mixing-caps")
    whole = patterns.agg(F.sum("pattern_size").alias("size")).first()["size"] or 0
    parts = filled.agg(F.sum("weight").alias("parts")).first()["parts"] or 0.0
    rest, left = F.lit(total_share * whole) - F.col("words"), F.lit(float(parts)) - F.col("parts")
    first = filled.where(F.col("cap") * left > rest * F.col("weight")).agg(F.min_by(F.struct("turn", (rest / left).alias("level")), "turn").alias("at")).first()["at"]
    if first is None:
        target = F.col("cap")
    else:
        target = F.when(F.col("turn") < first["turn"], F.col("cap")).otherwise(F.lit(first["level"]) * F.col("weight"))
    return filled.select("sources", "pattern_size", "n", target.alias("target"))


def running(df: DataFrame, order: list[Column], sums: dict[str, Column], label: str) -> DataFrame:
    """Sums over the rows before each row, in the given order of the whole table: rows are
    dealt by range, and a range starts with what the ranges before it sum up to."""
    keys = [c.alias(f"key{i}") for i, c in enumerate(order)]
    dealt = df.select("*", *keys, *(c.alias(k) for k, c in sums.items())).orderBy(*(f"key{i}" for i in range(len(order))))
    dealt = staged(dealt.withColumn("part", F.spark_partition_id()), label)
    totals = dealt.groupBy("part").agg(*(F.sum(k).alias(f"{k}_base") for k in sums))
    # one row per partition of the sort
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", *(F.coalesce(F.sum(f"{k}_base").over(before), F.lit(0)).alias(f"{k}_base") for k in sums))
    inside = Window.partitionBy("part").orderBy(*(f"key{i}" for i in range(len(order)))).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.select("*", *(F.coalesce(F.sum(k).over(inside), F.lit(0)).alias(f"{k}_inside") for k in sums)).join(bases, "part")
    return placed.select(*df.columns, *((F.col(f"{k}_base") + F.col(f"{k}_inside")).alias(k) for k in sums))


def overlapping(
    patterns: DataFrame, weights: tuple[float, ...], total_share: float, most: int, most_patterns: int
) -> tuple[DataFrame, DataFrame]:
    """Flows of patterns and targets of sources, solved on the driver."""
    spark = patterns.sparkSession
    rows = patterns.limit(most_patterns + 1).collect()
    if len(rows) > most_patterns:
        raise ValueError(f"more than {most_patterns} overlapping patterns of sources")
    target, flows = solve(rows, weights, total_share, most)
    table = spark.createDataFrame(
        [(list(r["sources"]), int(r["pattern_size"]), int(r["n"]), int(sum(f.values()))) for r, f in zip(rows, flows, strict=True)],
        "sources array<string>, pattern_size long, n long, flow long",
    )
    per_source = spark.createDataFrame(
        [(s, int(size), float(t)) for s, (size, t) in target.items()], "source string, source_size long, target double"
    )
    return table, per_source


def solve(patterns, weights: tuple[float, ...], total_share: float, most: int) -> tuple[dict, list[dict[int, int]]]:
    """Target and size of each source, and the flow of each pattern."""
    names = sorted({s for r in patterns for s in r["sources"]}, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    index = {s: i for i, s in enumerate(names)}
    sizes = [0] * len(names)
    for r in patterns:
        for s in r["sources"]:
            sizes[index[s]] += r["pattern_size"]
    total = total_share * sum(r["pattern_size"] for r in patterns)
    given = [weights[i % len(weights)] for i in range(len(names))]
    targets = water_fill(sizes, given, total, most)
    ids = [tuple(index[s] for s in r["sources"]) for r in patterns]
    flows = route([(m, int(r["pattern_size"])) for m, r in zip(ids, patterns, strict=True)], [round(t) for t in targets], most)
    return {s: (sizes[i], targets[i]) for s, i in index.items()}, flows
