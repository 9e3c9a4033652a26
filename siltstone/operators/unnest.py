"""Joins on the elements of a JSON list and the sums over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.jsonx import explode_text


def element_values(
    base: DataFrame, json_column: str, keys: list[str], lookup: DataFrame, lookup_key: str, value: str, how: str
) -> DataFrame:
    """``keys`` and ``_value``, the element's ``lookup.value``, for every list element."""
    elements = explode_text(base, json_column, "_element", *keys)
    values = lookup.select(F.col(lookup_key).alias("_element"), F.col(value).alias("_value"))
    return elements.join(values, "_element", how).select(*keys, "_value")


def element_sums(
    base: DataFrame,
    json_column: str,
    keys: list[str],
    lookup: DataFrame,
    lookup_key: str,
    value: str,
    total: str,
    how: str,
) -> DataFrame:
    """Sum of ``lookup.value`` over the list elements, per ``keys``.

    ``how='left'`` keeps keys none of whose elements are found (their total is null);
    ``how='inner'`` drops them. Keys whose lists are all empty or null are absent either
    way. Only the keys and the element reach the join, and the grouping combines before
    its shuffle, so a key with many elements costs no more than its share.
    """
    values = element_values(base, json_column, keys, lookup, lookup_key, value, how)
    return values.groupBy(*keys).agg(F.sum("_value").alias(total))
