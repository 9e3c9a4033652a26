"""Substring dedup over words by super-k-mer partitioning.

A window is `length` consecutive words of one text. Consecutive windows that share a
minimiser (the run of `gram` words with the smallest hash) are one super-k-mer and travel as
one packed string to the minimiser's bucket; there a sort of the windows by their
words puts equal ones side by side, so that
they are counted exactly. Every word covered by a window that starts at more than one place,
in any text or twice in one, is removed.

Null is a text without words; texts shorter than a window keep all words. Rows with equal
text (also equal in everything) repeat each other. An empty table gives no rows; extra
columns do not matter.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from siltstone.llm.repeats import Windows, remove_repeats

LENGTH, GRAM = 35, 10


def pair_names(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dense numbers of pairs; equal pairs have equal numbers."""
    key = a.astype(np.uint64) * np.uint64(int(b.max(initial=0)) + 1) + b.astype(np.uint64)
    return np.unique(key, return_inverse=True)[1]


def run_names(values: np.ndarray, width: int) -> np.ndarray:
    """Dense numbers of all runs of `width` values, by doubling; equal runs, equal numbers."""
    names, size = np.unique(values, return_inverse=True)[1], 1
    while size < width:
        step = min(size, width - size)
        names = pair_names(names[:-step], names[step:])
        size += step
    return names


def sorted_windows(values: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which windows equal another window of their group: sort, then compare neighbours."""
    names = run_names(values, length)[starts]
    order = np.lexsort((names, group))
    g, n = group[order], names[order]
    same = (g[1:] == g[:-1]) & (n[1:] == n[:-1])
    hit = np.zeros(len(starts), bool)
    hit[order[1:]] |= same
    hit[order[:-1]] |= same
    return hit


def remove_repeated_windows(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """Per row: the id, n_units (words), n_removed, n_spans, and what is left (see
    `repeats.remove_repeats`): kept words joined by one space."""

    def repeated(values: np.ndarray, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        return sorted_windows(values, starts, group, length)

    return remove_repeats(df, [id_col], text_col, Windows("word", length, min(gram, length)), repeated, "superkmer")
