"""Metric layer: minute windows, kept up to date with the commits of silver."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions.dates import day_of
from tradelake.operators.merge import merged_rows
from tradelake.operators.metrics import all_metrics, merged_stats, merged_vwap, published_stats, published_vwap
from tradelake.schemas import SILVER, STATS_TABLE, VWAP_TABLE, Layout, gold_schema
from tradelake.sources import snapshots
from tradelake.sources.snapshots import Snapshot
from tradelake.sources.tables import micros, read_silver, staged

TABLES: Sequence[str] = (VWAP_TABLE, STATS_TABLE)


def gold_rows(silver: DataFrame, refreshed_at: datetime, by: tuple[str, ...] = ()) -> DataFrame:
    """Both tables' columns per minute, stamped with the refresh time.

    ``updated_at`` is the refresh time rather than the newest arrival, because a window
    also changes when a trade leaves it. It is for readers; the export goes by commits.
    """
    return _stamped(all_metrics(silver, by=by), refreshed_at)


def _stamped(windows: DataFrame, refreshed_at: datetime) -> DataFrame:
    return windows.withColumns({"updated_at": F.lit(refreshed_at), "window_date": day_of("window_start")})


def read(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """A gold table with its internal columns."""
    return snapshots.read(spark, layout.gold(table), gold_schema(table, layout.by))


def published(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """A gold table as readers see it."""
    rows = read(spark, layout, table)
    return published_vwap(rows, layout.by) if table == VWAP_TABLE else published_stats(rows, layout.by)


def _write(rows: DataFrame, layout: Layout, table: str) -> dict[str, snapshots.Piece]:
    columns = gold_schema(table, layout.by).names
    return snapshots.write(rows.select(*columns), layout.gold(table), "window_date", ["window_start"], "window_start")


def _notes(silver: Snapshot, run_at: datetime, foreign: list[str]) -> dict:
    return {"silver": silver.number, "refreshed_at": micros(run_at), "foreign": foreign}


def rebuild(spark: SparkSession, layout: Layout, run_at: datetime) -> int:
    """Full rebuild of both tables from one aggregation; empty silver empties them."""
    silver = snapshots.current(spark, layout.silver) or snapshots.EMPTY
    trades = read_silver(spark, layout.silver, snapshot=silver)
    with staged(gold_rows(trades, run_at, layout.by), "gold-all") as rows:
        windows = rows.count()
        for table in TABLES:
            before = snapshots.current(spark, layout.gold(table))
            snapshots.commit(spark, layout.gold(table), before, _write(rows, layout, table), None, _notes(silver, run_at, []))
    return windows


@dataclass(frozen=True)
class Pending:
    """What silver commits after ``since`` mean for gold, as keys of silver days."""

    since: int
    whole: set[str]  # rows went away or changed, or a stream wrote windows: aggregated anew
    grown: set[str]  # only pieces came: their trades are added to the windows

    @property
    def days(self) -> list[date]:
        return sorted(snapshots.key_day(key) for key in self.whole | self.grown)

    def reads(self, key: str, piece: snapshots.Piece) -> bool:
        return key in self.grown and piece.number > self.since


def pending(silver: Snapshot, made: list[Snapshot], reconcile: bool = False) -> Pending:
    """Days to bring up to date, by what the tables ``made`` have seen of silver.

    With ``reconcile`` also those that a stream has written to, changed or not.
    """
    seen = [snapshot.notes["silver"] for snapshot in made]
    changed = silver.changed_since(min(seen))
    foreign = {snapshots.key_day(key) for snapshot in made for key in snapshot.notes["foreign"]}
    grown = {
        key for key in changed if min(seen) == max(seen) and silver.days[key].replaced <= min(seen) and snapshots.key_day(key) not in foreign}
    again = {snapshots.day_key("trade_date", day) for day in foreign} if reconcile else set()
    return Pending(min(seen), set(changed) - grown | again, grown)


def refresh(spark: SparkSession, layout: Layout, run_at: datetime, reconcile: bool = False) -> list[date]:
    """Bring gold up to date with the commits of silver since the one it was made of.

    Commits are told apart by number, so it doesn't matter whether ``run_at`` repeats or goes
    back. On days that only gained trades, the new pieces alone are aggregated and added to the stored
    windows: sums exactly, the variance by its state. Days that hold corrected or moved trades,
    and those that a stream has written to, are aggregated anew. Either way the
    result equals a full rebuild. If a run dies between the tables, the days are computed anew.
    ``reconcile`` takes back what a stream wrote: silver then decides on those days too.
    """
    silver = snapshots.current(spark, layout.silver)
    if silver is None:
        return []
    made = [snapshots.current(spark, layout.gold(table)) for table in TABLES]
    if not all(made) or any(not 0 <= snapshot.notes.get("silver", -1) <= silver.number for snapshot in made):
        rebuild(spark, layout, run_at)
        return [snapshots.key_day(key) for key in silver.days]
    todo = pending(silver, made, reconcile)
    if not todo.days:
        return []
    anew = gold_rows(snapshots.on_keys(spark, layout.silver, SILVER, todo.whole, silver), run_at, layout.by)
    more = gold_rows(snapshots.read(spark, layout.silver, SILVER, silver, todo.reads), run_at, layout.by)
    parts = [rows.withColumn("_whole", F.lit(whole)) for rows, whole, days in ((anew, True, todo.whole), (more, False, todo.grown)) if days]
    keys = {key: snapshots.day_key("window_date", snapshots.key_day(key)) for key in todo.whole | todo.grown}
    merge = {VWAP_TABLE: merged_vwap, STATS_TABLE: merged_stats}
    with staged(reduce(DataFrame.unionByName, parts), "gold-days") as rows:
        for table, before in zip(TABLES, made):
            schema, root = gold_schema(table, layout.by), layout.gold(table)
            out = rows.filter("_whole").select(*schema.names)
            if todo.grown:
                held = snapshots.on_keys(spark, root, schema, {keys[key] for key in todo.grown}, before)
                both = held.unionByName(rows.filter("not _whole").select(*schema.names))
                grown = _stamped(merge[table](both, layout.window_key), run_at)
                out = out.unionByName(grown.select(*schema.names))
            foreign = sorted(set(before.notes["foreign"]) - {keys[key] for key in todo.whole})
            snapshots.commit(spark, root, before, _write(out, layout, table), keys.values(), _notes(silver, run_at, foreign))
    return todo.days


def upsert_windows(windows: DataFrame, layout: Layout, table: str = VWAP_TABLE) -> None:
    """Replace single windows of one table by key (the streaming sink's step), as one commit.

    Its days are noted, because nobody knows which trades of silver such windows hold.
    """
    spark, schema, root = windows.sparkSession, gold_schema(table, layout.by), layout.gold(table)
    with staged(windows.select(*schema.names), "windows") as rows:
        found = rows.agg(F.collect_set("window_date").alias("days"), F.unix_micros(F.max("updated_at")).alias("at")).first()
        if not found.days:
            return
        before = snapshots.current(spark, root)
        keys = [snapshots.day_key("window_date", day) for day in found.days]
        held = snapshots.on_keys(spark, root, schema, keys, before)
        pieces = _write(merged_rows(held, rows, layout.window_key), layout, table)
        foreign = sorted({*keys, *(before or snapshots.EMPTY).notes.get("foreign", [])})
        snapshots.commit(spark, root, before, pieces, keys, {"refreshed_at": found["at"], "foreign": foreign})
