"""Bookmarks of the export: one partition per table name, so an upsert replaces one partition.

What silver, gold and the lake have taken from the layer before is not kept here but in the
notes of their own manifests, so that it changes together with their rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions.windows import aware, from_micros
from tradelake.schemas import EXPORT_STATE, Layout, safe_name
from tradelake.sources.tables import overwrite_partition, read_table


def moment(row, field: str) -> datetime | None:
    """The microsecond count in a possibly absent row, as a datetime."""
    return from_micros(row[field]) if row is not None else None


def _one_row(spark: SparkSession, values: tuple, schema: T.StructType) -> DataFrame:
    columns = [F.lit(value).cast(field.dataType).alias(field.name) for value, field in zip(values, schema.fields, strict=True)]
    return spark.range(0, 1, 1, 1).select(*columns)


def upsert_export_state(spark: SparkSession, layout: Layout, table: str, last_exported_at: datetime, rows_exported: int, rows_total: int) -> None:
    """Record a finished export; call it only after the write succeeded."""
    row = (aware(last_exported_at, "last_exported_at"), rows_exported, rows_total, safe_name(table))
    overwrite_partition(_one_row(spark, row, EXPORT_STATE), layout.state, "table_name")


def read_export_state(spark: SparkSession, layout: Layout):
    return read_table(spark, layout.state, EXPORT_STATE)


def export_bookmark(spark: SparkSession, layout: Layout, table: str) -> datetime | None:
    """Bookmark of the last export, None when the table was never exported."""
    rows = read_export_state(spark, layout).filter(F.col("table_name") == table)
    return moment(rows.select(F.unix_micros("last_exported_at").alias("at")).first(), "at")
