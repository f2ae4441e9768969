"""Publishing gold as a date-partitioned Parquet dataset."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tradelake.functions.dates import UNDATED
from tradelake.functions.windows import from_micros, with_date_parts
from tradelake.operators.metrics import published_stats, published_vwap
from tradelake.plans import gold, state
from tradelake.schemas import DATE_PARTS, VWAP_TABLE, Layout, gold_schema, lake_schema, safe_name
from tradelake.sources import snapshots
from tradelake.sources.catalog import register_views
from tradelake.sources.snapshots import Snapshot
from tradelake.sources.tables import date_part_key


@dataclass(frozen=True)
class ExportReport:
    table: str
    ok: bool
    full: bool = False
    rows_written: int = 0
    rows_total: int = 0
    days: int = 0
    error: str | None = None
    replica_error: str | None = None


class ExportFailed(RuntimeError):
    """Some tables could not be exported; ``reports`` covers all of them."""

    def __init__(self, reports: Sequence[ExportReport]):
        self.reports = list(reports)
        failed = [r.table for r in reports if not r.ok]
        super().__init__(f"export failed for: {', '.join(failed)}")


def publishable(rows: DataFrame, table: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Published columns and the directory names."""
    shaped = published_vwap if table == VWAP_TABLE else published_stats
    return with_date_parts(shaped(rows, by=by)).select(*lake_schema(table, by).names)


def _publish(spark: SparkSession, layout: Layout, table: str, rows: DataFrame, source: Snapshot, replaced: set[str] | None) -> dict:
    root = layout.lake(table)
    before = snapshots.current(spark, root)
    pieces = snapshots.write(publishable(rows, table, layout.by), root, DATE_PARTS, ["window_start"], "window_start")
    after = snapshots.commit(spark, root, before, pieces, replaced, {"gold": source.number})
    return {"rows": sum(piece.rows for piece in pieces.values()), "days": len(pieces), "total": after.rows}


def full_export(spark: SparkSession, layout: Layout, table: str) -> dict:
    """Publish the whole table in one commit; an emptied table is published as such."""
    root = layout.gold(safe_name(table))
    source = snapshots.current(spark, root) or snapshots.EMPTY
    rows = snapshots.read(spark, root, gold_schema(table, layout.by), source)
    return _publish(spark, layout, table, rows, source, None)


def incremental_export(spark: SparkSession, layout: Layout, table: str, after: int) -> dict:
    """Publish again every day that gold changed since its commit ``after``.

    Days are replaced whole, so open and late windows are brought up to date, days that
    gold no longer has go away, and repeating the export changes nothing. It makes no
    difference who changed gold, a refresh or a stream, or what stamp it used.
    """
    root = layout.gold(safe_name(table))
    source = snapshots.current(spark, root) or snapshots.EMPTY
    changed = source.changed_since(after)
    if not changed:
        return {"rows": 0, "days": 0, "total": (snapshots.current(spark, layout.lake(table)) or snapshots.EMPTY).rows}
    rows = snapshots.on_keys(spark, root, gold_schema(table, layout.by), changed, source)
    days = {snapshots.key_day(key) for key in changed}
    # windows without a time are kept under a day of their own
    replaced = {date_part_key(day) for day in days} | ({date_part_key(None)} if UNDATED in days else set())
    return _publish(spark, layout, table, rows, source, replaced)


def row_count(spark: SparkSession, layout: Layout, table: str) -> int:
    """Rows of an exported dataset (0 when there is none), as its manifest counts them."""
    return (snapshots.current(spark, layout.lake(table)) or snapshots.EMPTY).rows


def replicate(spark: SparkSession, layout: Layout, table: str, replica: str) -> None:
    """Bring a second root to the state of the dataset, whatever it missed before."""
    snapshots.copy(spark, layout.lake(table), Layout(replica).lake(table))


def export_table(spark: SparkSession, layout: Layout, table: str, replica: str | None = None) -> ExportReport:
    """Export one table: full the first time, incremental afterwards.

    The lake notes the gold commit that it shows, in the commit that shows it. A
    failing replica is reported and does not undo the export; the next run makes up for it.
    """
    try:
        source = snapshots.current(spark, layout.gold(safe_name(table)))
        lake = snapshots.current(spark, layout.lake(table))
        if source is None and lake is None:
            return ExportReport(table, True, True)
        full = lake is None or source is not None and source.number < lake.notes["gold"]  # gold was made anew
        written = full_export(spark, layout, table) if full else incremental_export(spark, layout, table, lake.notes["gold"])
        if written["days"] or full:
            at = from_micros(source.notes.get("refreshed_at", 0))
            state.upsert_export_state(spark, layout, table, at, written["rows"], written["total"])
    except Exception as error:  # one table's failure must not stop the others
        return ExportReport(table, ok=False, error=str(error))
    replica_error = None
    if replica:
        try:
            replicate(spark, layout, table, replica)
        except Exception as error:  # the replica is best effort
            replica_error = str(error)
    return ExportReport(table, True, full, written["rows"], written["total"], written["days"], replica_error=replica_error)


def run_export(spark: SparkSession, layout: Layout, tables: Sequence[str] = gold.TABLES, replica: str | None = None) -> list[ExportReport]:
    """Export every table on its own, refresh the views, then report failures."""
    reports = [export_table(spark, layout, table, replica) for table in tables]
    register_views(spark, layout)
    if not all(report.ok for report in reports):
        raise ExportFailed(reports)
    return reports
