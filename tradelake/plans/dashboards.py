"""The four charts, over the last hour or the latest windows."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradelake.schemas import STATS_TABLE, VWAP_TABLE, Layout, lake_schema
from tradelake.sources import snapshots
from tradelake.sources.snapshots import Snapshot
from tradelake.sources.tables import read_gold


def _sell_share():
    return (F.lit(100.0) - F.col("buy_volume_pct")).alias("sell_volume_pct")


# chart -> (table, columns after window_start)
CHARTS = {
    "vwap": (VWAP_TABLE, lambda: ["vwap"]),
    "volume": (VWAP_TABLE, lambda: ["total_volume"]),
    "pressure": (STATS_TABLE, lambda: ["buy_volume_pct", _sell_share()]),
    "volatility": (STATS_TABLE, lambda: ["volatility"]),
}


def chart(windows: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The columns one chart shows."""
    _, columns = CHARTS[name]
    return windows.select(*by, "window_start", *columns())


def recent(spark: SparkSession, layout: Layout, name: str, as_of: datetime | None = None, minutes: int = 60) -> DataFrame:
    """Windows that started in the ``minutes`` up to ``as_of``, oldest first.

    Only the pieces that can hold them are opened, as the manifest tells.
    """
    since = (as_of or datetime.now(UTC)) - timedelta(minutes=minutes)
    table, _ = CHARTS[name]
    windows = read_gold(spark, layout.lake(table), table, since=since, by=layout.by)
    if as_of is not None:
        windows = windows.filter(F.col("window_start") <= F.lit(as_of))
    return chart(windows, name, layout.by).orderBy("window_start")


def newest_days(snapshot: Snapshot, n: int, by: tuple[str, ...] = ()) -> set[str]:
    """Keys of the days that hold the newest ``n`` windows, from the manifest alone.

    Without further keys a row is a window; with them a day is only known to hold one window.
    """
    days = [(max(p.high for p in day.pieces if p.high is not None), key, 1 if by else sum(p.rows for p in day.pieces))
            for key, day in snapshot.days.items() if any(p.high is not None for p in day.pieces)]
    found, held = set(), 0
    for _, key, windows in sorted(days, reverse=True):
        if held >= n:
            break
        found.add(key)
        held += windows
    return found


def latest(spark: SparkSession, layout: Layout, name: str, n: int = 5) -> DataFrame:
    """The newest ``n`` windows, newest first (a distributed top-k), each with the rows of all its keys."""
    table, _ = CHARTS[name]
    root = layout.lake(table)
    snapshot = snapshots.current(spark, root) or snapshots.EMPTY
    windows = snapshots.on_keys(spark, root, lake_schema(table, layout.by), newest_days(snapshot, n, layout.by), snapshot)
    if not layout.by:
        return chart(windows, name).orderBy(F.desc("window_start")).limit(n)
    newest = windows.withColumn("_place", F.dense_rank().over(Window.orderBy(F.desc("window_start")))).filter(F.col("_place") <= n)
    return chart(newest, name, layout.by).orderBy(F.desc("window_start"), *layout.by)
