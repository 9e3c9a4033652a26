"""Time-interval joins.

Both operators look at ``right`` rows whose time lies in
``[left - before, left + after]``, both ends included:

* ``interval_join`` returns the matching pairs.
* ``interval_aggregate`` returns count / max / min / sum per left time without ever
  forming a pair.

Spark plans the plain condition as a nested loop over all pairs, so both turn it into
equality joins on integer time cells.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.exprs import epoch_micros
from siltstone.session import require_utc

# Rows per side of one block of an interval join: a task never pairs more than
# BLOCK_ROWS x BLOCK_ROWS rows for one key.
BLOCK_ROWS = 4096

# A cell of one level is made of 2**LEVEL_BITS cells of the level below.
LEVEL_BITS = 4


def _micros(delta: dt.timedelta) -> int:
    return delta // dt.timedelta(microseconds=1)


def _counted(df: DataFrame, block_rows: int) -> DataFrame:
    """Full copies of a row as one row with ``_copies``, in chunks of ``block_rows``.

    Copies hash alike, so no salt could part them; a count and a chunk number can.
    """
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    last_chunk = F.call_function("div", F.col("_n") - 1, F.lit(block_rows))
    chunked = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)).alias("_chunk"))
    return chunked.select(
        *df.columns,
        "_chunk",
        F.least(F.lit(block_rows), F.col("_n") - F.col("_chunk") * block_rows).alias("_copies"),
    )


def _keyed(df: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumns({f"{prefix}{i}": F.col(f"`{c}`") for i, c in enumerate(columns)})


def _cell_grid(
    lu: Column, left: DataFrame, ru: Column, right: DataFrame, keys: list[str], bits: int, reach: int, block: int
):
    """One row per key and cell both sides touch: the right side's extremes, blocks per side.

    Its size follows the time span and the number of keys, not the rows; how it is joined
    is left to adaptive execution.
    """
    rcells = right.groupBy(*keys, F.shiftright(ru, bits).alias("_cell")).agg(
        F.count(F.lit(1)).alias("_nr"), F.min(ru).alias("_first"), F.max(ru).alias("_last")
    )
    starts = left.groupBy(*keys, F.shiftright(lu, bits).alias("_cell0")).agg(F.count(F.lit(1)).alias("_nl"))
    lcells = (
        starts.select(*keys, F.explode(F.sequence(F.col("_cell0"), F.col("_cell0") + reach)).alias("_cell"), "_nl")
        .groupBy(*keys, "_cell")
        .agg(F.sum("_nl").alias("_nl"))
    )
    return rcells.join(lcells, [*keys, "_cell"]).select(
        *keys,
        "_cell",
        "_first",
        "_last",
        F.ceil(F.col("_nl") / block).alias("_rows"),
        F.ceil(F.col("_nr") / block).alias("_cols"),
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_ts: str,
    right_ts: str,
    before: dt.timedelta,
    after: dt.timedelta,
    how: str = "left",
    block_rows: int = BLOCK_ROWS,
    on: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Join on ``right_ts BETWEEN left_ts - before AND left_ts + after``, and on equality
    of the column pairs (left, right) named in ``on``; a null there equals nothing.

    A right row has one time cell (per key), a left row visits the few cells its window touches,
    so each pair meets in exactly one cell. Cells are at most half a window wide: two
    thirds or more of the rows that meet are real pairs, and work follows the result's
    size. A cell's first and last right time tell exactly whether a left row finds a
    partner there; one that finds none anywhere keeps a single copy with nulls.

    A crowded cell is cut into a grid of blocks of at most ``block_rows`` rows per side.
    Its left rows are spread over the grid's rows and its right rows over the columns,
    so every pair still meets once, in some task of its own.

    ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    require_utc(left.sparkSession)
    lower, span = _micros(before), _micros(before) + _micros(after)
    bits = max(0, (span // 2).bit_length() - 1)
    reach = (span >> bits) + 1

    start = epoch_micros(left_ts) - F.lit(lower)
    lkeys, rkeys = [c for c, _ in on], [c for _, c in on]
    keys = [f"_k{i}" for i in range(len(on))]
    grid = _cell_grid(
        start,
        _keyed(left, lkeys, "_k"),
        epoch_micros(right_ts),
        _keyed(right, rkeys, "_k"),
        keys,
        bits,
        reach,
        block_rows,
    )

    # For each start cell the occupied cells within reach: at most reach + 1 of them.
    around = (
        grid.select(
            *keys,
            F.explode(F.sequence(F.col("_cell") - reach, F.col("_cell"))).alias("_cell0"),
            F.struct("_cell", "_first", "_last", "_rows", "_cols").alias("_c"),
        )
        .groupBy(*keys, "_cell0")
        .agg(F.collect_list("_c").alias("_cells"))
    )
    lsalt = F.xxhash64(*(F.col(f"`{c}`") for c in left.columns), "_lchunk")
    visits = (
        _keyed(_counted(left, block_rows), lkeys, "_k")
        .withColumnsRenamed({"_chunk": "_lchunk", "_copies": "_lcopies"})
        .withColumn("_a", start)
        .withColumn("_cell0", F.shiftright("_a", bits))
        .join(around, [*keys, "_cell0"], "left")
        .select(
            *left.columns,
            *keys,
            "_lchunk",
            "_lcopies",
            "_a",
            F.explode_outer(
                F.filter("_cells", lambda c: (c["_last"] >= F.col("_a")) & (c["_first"] <= F.col("_a") + span))
            ).alias("_c"),
        )
    )
    lblocks = visits.select(
        *left.columns,
        *keys,
        "_lcopies",
        "_a",
        F.col("_c._cell").alias("_cell"),
        # rows without a partner are spread by the whole salt
        F.coalesce(F.pmod(lsalt, F.col("_c._rows")), lsalt).alias("_row"),
        F.explode_outer(F.sequence(F.lit(0).cast("long"), F.col("_c._cols") - 1)).alias("_column"),
    )
    rsalt = F.xxhash64(*(F.col(f"`{c}`") for c in right.columns), "_chunk")
    rblocks = (
        _keyed(_counted(right, block_rows), rkeys, "_r")
        .withColumn("_u", epoch_micros(right_ts))
        .withColumn("_rcell", F.shiftright("_u", bits))
        .join(
            grid.select(
                *(F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)), F.col("_cell").alias("_rcell"), "_rows", "_cols"
            ),
            [*(f"_r{i}" for i in range(len(on))), "_rcell"],
        )
        .select(
            *right.columns,
            *(f"_r{i}" for i in range(len(on))),
            "_u",
            "_copies",
            "_rcell",
            F.pmod(rsalt, F.col("_cols")).alias("_rcolumn"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1)).alias("_rrow"),
        )
    )
    met = (
        (F.col("_cell") == F.col("_rcell"))
        & (F.col("_row") == F.col("_rrow"))
        & (F.col("_column") == F.col("_rcolumn"))
        & F.col("_u").between(F.col("_a"), F.col("_a") + span)
    )
    for i, key in enumerate(keys):
        met &= F.col(key) == F.col(f"_r{i}")
    pairs = lblocks.join(rblocks, met, how)
    if how == "left":
        # a visited block may hold none of the row's partners: that is no missing partner
        pairs = pairs.where(F.col("_cell").isNull() | F.col("_u").isNotNull())
    copies = F.sequence(F.lit(1).cast("long"), F.col("_lcopies") * F.coalesce("_copies", F.lit(1)))
    return pairs.withColumn("_copy", F.explode(copies)).select(*left.columns, *right.columns)


def interval_aggregate(
    left: DataFrame,
    right: DataFrame,
    left_ts: str,
    right_ts: str,
    before: dt.timedelta,
    after: dt.timedelta,
    aggregates: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Aggregates over the right rows in each left row's window, one row per left time.

    ``aggregates`` maps an output name to ``(function, right column)`` with function
    ``count``, ``sum``, ``max`` or ``min``. Returns distinct ``left_ts`` values that have
    at least one right row, with the aggregates.

    The right side is summed up in time cells at several levels, each 16 times as wide as the one
    below. A window is cut into runs of cells: at each level one at its left end and one at its
    right end, each within one wider cell, and what lies between is left to the next level. So a left
    time needs at most two lookups a level, each of which meets the at most 16 cells of a wider
    one, however many rows its window holds: no pair is formed and no group is gathered. All
    groupings combine before they shuffle, so a hot instant or day is no hot key.
    """
    require_utc(left.sparkSession)
    first = {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min}
    again = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}
    lower, upper = _micros(before), _micros(after)
    top = 0
    while (1 << (LEVEL_BITS * (top + 1))) <= lower + upper + 1:
        top += 1

    def merged():
        return [again[fn](name).alias(name) for name, (fn, _) in aggregates.items()]

    levels = F.explode(F.sequence(F.lit(0), F.lit(top)))
    cells = (
        right.select(epoch_micros(right_ts).alias("_u"), *(F.col(c).alias(name) for name, (_, c) in aggregates.items()), levels.alias("_level"))
        .groupBy("_level", F.expr(f"shiftright(_u, {LEVEL_BITS} * _level)").alias("_cell"))
        .agg(*(first[fn](name).alias(name) for name, (fn, _) in aggregates.items()))
    )

    windows = (
        left.select(left_ts)
        .distinct()
        .select(
            left_ts,
            (epoch_micros(left_ts) - F.lit(lower)).alias("_a"),
            (epoch_micros(left_ts) + F.lit(upper + 1)).alias("_b"),
            levels.alias("_level"),
        )
    )
    # At a level the window holds the whole cells [lo, hi); those inside the next level's
    # whole cells [lo_up, hi_up) are left to that level.
    bits, bits_up = f"{LEVEL_BITS} * _level", f"{LEVEL_BITS} * (_level + 1)"
    lo, hi = F.expr(f"-shiftright(-_a, {bits})"), F.expr(f"shiftright(_b, {bits})")
    lo_up = F.expr(f"shiftleft(-shiftright(-_a, {bits_up}), {LEVEL_BITS})")
    hi_up = F.expr(f"shiftleft(shiftright(_b, {bits_up}), {LEVEL_BITS})")

    def run(start: Column, end: Column) -> Column:
        return F.struct(start.alias("from"), end.alias("to"))

    # where no wider cell is whole, the cells lie in one wide cell or on both sides of one border
    left_end = F.when(lo_up <= hi_up, lo_up).otherwise(hi)
    right_start = F.when(lo_up <= hi_up, hi_up).otherwise(hi)
    some = F.filter(F.array(run(lo, left_end), run(right_start, hi)), lambda r: r["from"] < r["to"])
    runs = windows.select(left_ts, "_level", F.explode(some).alias("_run")).select(
        left_ts,
        "_level",
        F.shiftright("_run.from", LEVEL_BITS).alias("_wide"),
        F.col("_run.from").alias("_from"),
        F.col("_run.to").alias("_to"),
    )
    wide = cells.withColumn("_wide", F.shiftright("_cell", LEVEL_BITS))
    met = runs.join(wide, ["_level", "_wide"]).where((F.col("_cell") >= F.col("_from")) & (F.col("_cell") < F.col("_to")))
    return met.groupBy(left_ts).agg(*merged())
