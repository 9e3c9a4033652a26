"""Substring dedup over bytes by a depth-limited suffix sort.

All suffixes that begin a window of `length` bytes are ordered through that depth only, by
passes from the most significant digit: a suffix in a group of its own is done, and the
groups left after the last pass are exactly the repeated windows. A digit is a run of
`DIGIT` bytes, numbered beforehand by doubling. The first digit is the window's anchor
(see `repeats`), which also deals suffixes to tasks. Every byte covered by a
repeated window is removed.

Null is an empty text; texts shorter than a window stay whole. Rows with equal text (also
equal in everything) repeat each other. Cuts may fall inside a character: `kept` is binary,
and `whole_characters` makes it a text again.
An empty table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.repeats import Windows, remove_repeats
from siltstone.llm.superkmer import pair_names, run_names

LENGTH, GRAM, DIGIT = 200, 40, 40


def digits_of(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of all runs of `width` bytes; eight bytes are read as one integer."""
    if width < 8 or len(values) < 8:
        return run_names(values, width)
    eight = np.lib.stride_tricks.sliding_window_view(np.ascontiguousarray(values), 8)
    names, size = np.unique(np.ascontiguousarray(eight).view(">u8")[:, 0], return_inverse=True)[1], 8
    while size < width:
        step = min(size, width - size)
        names = pair_names(names[:-step], names[step:])
        size += step
    return names


def radix_groups(values: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which windows equal another window of their group, by passes over their digits."""
    width = min(DIGIT, length)
    digit = digits_of(values, width)
    alive = np.arange(len(starts))
    for depth in [*range(0, length - width, width), length - width]:
        if not len(alive):
            break
        names = pair_names(group, digit[starts[alive] + depth])
        again = np.bincount(names)[names] > 1
        alive, group = alive[again], names[again]
    hit = np.zeros(len(starts), bool)
    hit[alive] = True
    return hit


def remove_repeated_bytes(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """Per row: the id, n_units (bytes), n_removed, n_spans, and what is left (see
    `repeats.remove_repeats`): the remaining bytes."""

    def repeated(values: np.ndarray, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        return radix_groups(values, starts, group, length)

    return remove_repeats(df, [id_col], text_col, Windows("byte", length, min(gram, length)), repeated, "suffix")


def uncut(kept: bytes | None, spans) -> str | None:
    """What is left of a text without the characters that the removed spans cut in two.

    Only bytes at a cut go; all else stays as it was, replacement characters too."""
    if kept is None:
        return None
    pieces, at, gone = [], 0, 0
    for s in () if spans is None else spans:
        cut = s["first"] - gone
        pieces.append(kept[at:cut])
        at, gone = cut, gone + s["stop"] - s["first"]
    pieces.append(kept[at:])
    out = []
    for i, piece in enumerate(pieces):
        if i:  # the end of a character whose beginning went
            skip = next((k for k in range(min(3, len(piece))) if piece[k] & 0xC0 != 0x80), min(3, len(piece)))
            piece = piece[skip:]
        if i + 1 < len(pieces):  # the beginning of one whose end went
            for k in range(1, min(3, len(piece)) + 1):
                lead = piece[-k]
                if lead & 0xC0 != 0x80:
                    size = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
                    piece = piece[:-k] if size > k else piece
                    break
        out.append(piece)
    return b"".join(out).decode("utf-8", "replace")


def whole_characters(kept: Column, spans: Column) -> Column:
    """The text of `kept` without characters cut in two; null where nothing was removed."""

    def run(kept: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([uncut(k, s) for k, s in zip(kept, spans, strict=True)], dtype=object)

    return F.pandas_udf(run, T.StringType())(kept, spans)
