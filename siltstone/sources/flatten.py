"""Nested objects to flat columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Every struct leaf as a column named by its path; lists stay whole."""

    def leaves(fields: list[T.StructField], parents: tuple[str, ...]) -> list[Column]:
        out: list[Column] = []
        for f in fields:
            path = (*parents, f.name)
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType.fields, path)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)))
        return out

    return df.select(*leaves(df.schema.fields, ()))
