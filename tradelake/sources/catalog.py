"""SQL views over the exported datasets."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tradelake.schemas import VIEW_NAMES, Layout
from tradelake.sources.tables import read_gold


def register_views(spark: SparkSession, layout: Layout) -> list[str]:
    """Create or replace one view per published table.

    A view over a dataset that does not exist yet has its columns and no rows.
    Register again after an export so that new files are listed.
    """
    for table, view in VIEW_NAMES.items():
        read_gold(spark, layout.lake(table), table, by=layout.by).createOrReplaceTempView(view)
    return list(VIEW_NAMES.values())
