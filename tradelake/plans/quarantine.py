"""Records set aside with the reasons for it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tradelake.schemas import QUARANTINE, Layout


def quarantine(rows: DataFrame, layout: Layout) -> None:
    """Store ``raw, reasons, received_at`` by ``batch_id``.

    Each batch is a partition of its own and is replaced as a whole, so reading
    the same batch again leaves the same rows.
    """
    (
        rows.select(*QUARANTINE.names)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(layout.quarantine)
    )
