"""Landed JSON responses as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.casts import to_ntz
from siltstone.functions.exprs import within_days
from siltstone.sources.catalog import DatasetSpec
from siltstone.sources.responses import stream_responses


def _record_list(body: Column, json_path: str) -> Column:
    """The list at a dotted path as variants; one object counts as a list of one."""
    root = F.parse_json(body)
    path = "$." + json_path
    as_list = F.try_variant_get(root, path, "array<variant>")
    as_object = F.try_variant_get(root, path, "map<string,variant>")
    return F.when(as_list.isNotNull(), as_list).when(
        as_object.isNotNull(), F.array(F.try_variant_get(root, path, "variant"))
    )


def records_at(df: DataFrame, body: str, json_path: str, schema: T.StructType) -> DataFrame:
    """Rows below ``json_path`` in a column of response bodies.

    A path that is missing, or leads through something that is no object, gives no rows.
    A malformed body fails the job.
    """
    records = df.select(F.explode(_record_list(F.col(body), json_path)).alias("record"))
    row = F.col("record").cast(schema).alias("row")
    return records.select(row).select("row.*")


def read_responses(spark: SparkSession, spec: DatasetSpec, location: str) -> DataFrame:
    """The landed files of one dataset, with its declared schema.

    A file may hold a list, one object, or (``json_lines``) one object per line; an empty
    list keeps the columns. Files other than JSON Lines are read by one task each, so land
    one response page per file. ``json_path`` bodies likewise.
    """
    if spec.streamed:
        return stream_responses(spark, location, spec.schema, spec.json_path)
    if spec.json_path:
        bodies = spark.read.text(location, wholetext=True)
        return records_at(bodies, "value", spec.json_path, spec.schema)
    reader = spark.read.schema(spec.schema).option("mode", "FAILFAST")
    return reader.option("multiLine", not spec.json_lines).json(location)


def in_window(df: DataFrame, spec: DatasetSpec, window: tuple[str, str] | None) -> DataFrame:
    """Keep the requested days of a dataset that is requested by window."""
    if window is None or spec.window_column is None:
        return df
    return df.where(within_days(to_ntz(spec.window_column), *window))


class LandedReader:
    """Default reader: ``<location>/<dataset name>``."""

    def read(self, spark: SparkSession, spec: DatasetSpec, location: str) -> DataFrame:
        return read_responses(spark, spec, f"{location}/{spec.name}")
