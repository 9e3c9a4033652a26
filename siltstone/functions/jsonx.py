"""JSON text columns: element access, unnesting, encoding.

JSON lists and objects stay JSON text in bronze. Reading one parses it once into a
VARIANT; malformed text raises instead of turning into null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMPLEX = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def first_element(json_text: Column | str) -> Column:
    """Element 0 of a JSON list as text; null for an empty list or no list."""
    return F.variant_get(F.parse_json(json_text), "$[0]", "string")


def first_element_key(json_text: Column | str, key: str) -> Column:
    """``key`` of element 0 of a JSON list of objects, as text."""
    return F.variant_get(F.parse_json(json_text), f"$[0].{key}", "string")


def first_fields(df: DataFrame, json_column: str, **keys: str) -> DataFrame:
    """The frame with a text column per ``name=key`` of element 0 of a JSON list of objects.

    The list is parsed once for all of them. It goes through a generator of one row, which the
    optimizer does not push filters through: a filter on a field would parse the list again.
    """
    shape = ", ".join(f"`{key}`: string" for key in keys.values())
    first = F.try_variant_get(F.parse_json(json_column), "$[0]", f"struct<{shape}>")
    parsed = df.select("*", F.explode_outer(F.array(first)).alias("_first"))
    return parsed.select(*(F.col(f"`{c}`") for c in df.columns), *(F.col(f"_first.`{key}`").alias(name) for name, key in keys.items()))


def elements_text(json_text: Column | str) -> Column:
    """JSON list to array of text; anything that is not a list raises."""
    return F.from_json(json_text, "array<string>", {"mode": "FAILFAST"})


def explode_text(df: DataFrame, json_column: str, alias: str, *keep: str) -> DataFrame:
    """One row per list element; rows with an empty or null list disappear.

    Only ``keep`` is carried along, so nothing else is copied per element.
    """
    return df.select(*keep, F.explode(elements_text(json_column)).alias(alias))


def is_valid_json(json_text: Column | str) -> Column:
    text = F.col(json_text) if isinstance(json_text, str) else json_text
    return text.isNull() | F.try_parse_json(text).isNotNull()


def encode_complex_columns(df: DataFrame) -> DataFrame:
    """Every list, map, struct and variant column as JSON text; nulls stay null."""
    return df.select(
        *(
            F.to_json(F.col(f"`{f.name}`"), {"ignoreNullFields": "false"}).alias(f.name)
            if isinstance(f.dataType, _COMPLEX)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )
