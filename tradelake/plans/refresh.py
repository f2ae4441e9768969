"""Bronze to published metrics in one gated run."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tradelake.functions.windows import aware
from tradelake.operators.quality import SILVER_SUITE, fresh_source, report, stats_suite, vwap_suite
from tradelake.plans import gold, silver
from tradelake.plans.export import ExportReport, run_export
from tradelake.schemas import BRONZE_TABLE, SILVER, SILVER_TABLE, STATS_TABLE, VWAP_TABLE, Layout, gold_schema
from tradelake.sources import snapshots
from tradelake.sources.tables import read_bronze


@dataclass(frozen=True)
class RefreshReport:
    changed_rows: int
    changed_days: int
    failed_checks: list[dict] = field(default_factory=list)
    exports: list[ExportReport] = field(default_factory=list)
    freshness: str = "pass"

    @property
    def published(self) -> bool:
        return not self.failed_checks


def quality_report(spark: SparkSession, layout: Layout, changed: dict[str, list[str]] | None = None, as_of: datetime | None = None) -> DataFrame:
    """Every declared check of the three tables, and with ``as_of`` the freshness of bronze.

    With ``changed`` (day keys by table), the row-level checks look at those days only: rows
    elsewhere have not changed since they were last checked. Uniqueness looks at
    every row of the table whose key occurs on those days.
    """
    suites = {
        SILVER_TABLE: (layout.silver, SILVER, SILVER_SUITE),
        VWAP_TABLE: (layout.gold(VWAP_TABLE), gold_schema(VWAP_TABLE, layout.by), vwap_suite(layout.window_key)),
        STATS_TABLE: (layout.gold(STATS_TABLE), gold_schema(STATS_TABLE, layout.by), stats_suite(layout.window_key)),
    }
    parts = []
    for name, (root, schema, suite) in suites.items():
        part = snapshots.on_keys(spark, root, schema, changed[name]) if changed is not None else None
        parts.append(report(snapshots.read(spark, root, schema), suite, name, part))
    if as_of is not None:
        parts.append(fresh_source(read_bronze(spark, layout.bronze), BRONZE_TABLE, as_of))
    return reduce(DataFrame.unionByName, parts)


def refresh(spark: SparkSession, layout: Layout, run_at: datetime, mode: str = "strict", replica: str | None = None, need_fresh: bool = False) -> RefreshReport:
    """Silver, gold, checks, export. Any failed check stops before the export.

    Checked are the days changed since the checks last passed, by commit number. The
    report says how fresh the source is at ``run_at``; a warning never stops a run, an
    error does with ``need_fresh``.
    """
    aware(run_at, "run_at")
    upserted = silver.upsert(spark, layout, run_at, mode)
    days = gold.refresh(spark, layout, run_at)
    roots = {SILVER_TABLE: layout.silver, **{table: layout.gold(table) for table in gold.TABLES}}
    tables = {name: snapshots.current(spark, root) or snapshots.EMPTY for name, root in roots.items()}
    passed = snapshots.current(spark, layout.checked)
    since = passed.notes if passed else {}
    changed = {name: table.changed_since(since.get(name, 0)) for name, table in tables.items()}
    checks = quality_report(spark, layout, changed if passed else None, run_at).filter("status <> 'pass'")
    found = [row.asDict() for row in checks.collect()]
    freshness = next((row["status"] for row in found if row["check"] == "freshness"), "pass")
    failed = [row for row in found if row["status"] == "fail" or need_fresh and row["status"] == "error"]
    if failed:
        exports = []
    else:
        snapshots.commit(spark, layout.checked, passed, {}, (), {name: table.number for name, table in tables.items()})
        exports = run_export(spark, layout, replica=replica)
    return RefreshReport(upserted.inserted_or_changed, len(days), failed, exports, freshness)
