"""Upkeep of the arrivals: small batches of bronze and the quarantine gathered into large files."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tradelake.schemas import BRONZE, QUARANTINE, Layout
from tradelake.sources import snapshots
from tradelake.sources.packed import PackReport, pack
from tradelake.sources.tables import read_table


def pack_bronze(spark: SparkSession, layout: Layout) -> PackReport:
    """Pack the bronze batches that silver has taken; the others may still be written."""
    silver = snapshots.current(spark, layout.silver) or snapshots.EMPTY
    ready = {"": silver.notes.get("taken", [])}
    return pack(spark, layout.bronze, read_table(spark, layout.bronze, BRONZE), "batch", ready)


def pack_quarantine(spark: SparkSession, layout: Layout) -> PackReport:
    """Pack the quarantine batches that are not the last of their writer."""
    return pack(spark, layout.quarantine, read_table(spark, layout.quarantine, QUARANTINE), "batch_id")


def pack_arrivals(spark: SparkSession, layout: Layout) -> dict[str, PackReport]:
    """Both, to be scheduled beside the refresh, hourly or daily."""
    return {"bronze": pack_bronze(spark, layout), "quarantine": pack_quarantine(spark, layout)}
