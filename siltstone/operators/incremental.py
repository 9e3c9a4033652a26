"""High-water mark, delete-and-insert by key, added columns: the frame-level part."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.exprs import ntz_literal


def high_water_mark(target: DataFrame, event_time: str) -> dt.datetime | None:
    """Newest event time of the target: one value, one column read."""
    return target.agg(F.max(event_time)).first()[0]


def newer_than(
    source: DataFrame,
    event_time: str,
    mark: dt.datetime | None,
    first_run: bool = False,
    empty_target: str = "nothing",
) -> DataFrame:
    """Source rows the next run has to load.

    Strict comparison with a literal, which reaches the scan. A first run takes all.
    A target that exists but is empty has no mark: by default nothing is newer than that
    (comparing with null), ``empty_target='full'`` loads everything instead.
    """
    if empty_target not in ("nothing", "full"):
        raise ValueError(f"unknown empty_target: {empty_target}")
    if first_run or (mark is None and empty_target == "full"):
        return source
    return source.where(F.col(event_time) > ntz_literal(mark))


def without_keys(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is not in the batch; a null key is never in it."""
    return target.join(batch.select(key).distinct(), key, "left_anti").select(*target.columns)


def add_columns(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Both row sets with the columns of both, in the target's order first."""
    return target.unionByName(batch, allowMissingColumns=True)


def delete_insert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Replace the target rows of the batch's keys by the batch.

    Nothing is de-duplicated inside the batch.
    """
    return add_columns(without_keys(target, batch, key), batch)
