"""Gold metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradelake.functions.windows import between_windows
from tradelake.operators.metrics import published_stats, published_vwap, trade_stats, vwap
from tradelake.operators.rolling import rolling_vwap
from tradelake.plans import gold
from tradelake.queries.common import (
    DELIVERED, LINES, TRADES, comparable, event_trades, line_trades, stats_sql, two_deliveries, vwap_sql, whole_tape,
)
from tradelake.schemas import STATS_TABLE, VWAP_TABLE

ROLL_SECONDS = 6 * 3600


def _vwap(unit, trades=event_trades, by=()):
    return lambda spark, folder: comparable(published_vwap(vwap(trades(spark, folder), unit, by), by))


def _stats(unit):
    return lambda spark, folder: comparable(published_stats(trade_stats(event_trades(spark, folder), unit)))


def _between(spark, folder):
    trades = event_trades(spark, folder)
    middle = trades.agg((F.unix_seconds(F.min("traded_at").cast("timestamp")) / 2 + F.unix_seconds(F.max("traded_at").cast("timestamp")) / 2).cast("bigint").alias("s"))
    from datetime import UTC, datetime

    cut = datetime.fromtimestamp(middle.first().s, UTC)
    return comparable(published_vwap(vwap(between_windows(trades, "traded_at", cut, None, "hour"), "hour")))


def _rolling(spark, folder):
    hours = vwap(event_trades(spark, folder), "hour", ["product_id"])
    return comparable(rolling_vwap(hours, ROLL_SECONDS, ["product_id"]))


QUERIES = {
    "gold_vwap_minute": _vwap("minute"),
    "gold_vwap_hour": _vwap("hour"),
    "gold_vwap_lineitem_day": _vwap("day", line_trades),
    "gold_vwap_product_hour": _vwap("hour", by=("product_id",)),
    "gold_trade_stats_minute": _stats("minute"),
    "gold_trade_stats_hour": _stats("hour"),
    "gold_vwap_between": _between,
    "gold_full_rebuild_vwap": lambda spark, folder: comparable(gold.published(spark, whole_tape(spark, folder), VWAP_TABLE)),
    "gold_full_rebuild_stats": lambda spark, folder: comparable(gold.published(spark, whole_tape(spark, folder), STATS_TABLE)),
    "gold_incremental_upsert": lambda spark, folder: comparable(gold.published(spark, two_deliveries(spark, folder), VWAP_TABLE)),
    "gold_incremental_stats": lambda spark, folder: comparable(gold.published(spark, two_deliveries(spark, folder), STATS_TABLE)),
    "rolling_vwap": _rolling,
}

SQL = {
    "gold_vwap_minute": f"WITH {TRADES} {vwap_sql('minute')}",
    "gold_vwap_hour": f"WITH {TRADES} {vwap_sql('hour')}",
    "gold_vwap_lineitem_day": f"WITH {LINES} {vwap_sql('day')}",
    "gold_vwap_product_hour": f"WITH {TRADES} {vwap_sql('hour', by='product_id, ')}",
    "gold_trade_stats_minute": f"WITH {TRADES} {stats_sql('minute')}",
    "gold_trade_stats_hour": f"WITH {TRADES} {stats_sql('hour')}",
    "gold_vwap_between": f"""WITH {TRADES},
cut AS (SELECT to_timestamp(CAST(floor(epoch(date_trunc('second', min(traded_at))) / 2
  + epoch(date_trunc('second', max(traded_at))) / 2) AS BIGINT)) AT TIME ZONE 'UTC' AS at FROM trades),
hours AS ({vwap_sql('hour')})
SELECT hours.* FROM hours, cut WHERE window_start >= cut.at""",
    "gold_full_rebuild_vwap": f"WITH {TRADES} {vwap_sql('minute')}",
    "gold_full_rebuild_stats": f"WITH {TRADES} {stats_sql('minute')}",
    "gold_incremental_upsert": f"WITH {DELIVERED} {vwap_sql('minute', 'delivered')}",
    "gold_incremental_stats": f"WITH {DELIVERED} {stats_sql('minute', 'delivered')}",
    "rolling_vwap": f"""WITH {TRADES},
hours AS (SELECT product_id, date_trunc('hour', traded_at) AS window_start,
  sum(price::DECIMAL(20,8) * size) AS pq, sum(size) AS q FROM trades GROUP BY ALL),
rolled AS (SELECT *, sum(pq) OVER w AS rpq, sum(q) OVER w AS rq FROM hours
  WINDOW w AS (PARTITION BY product_id ORDER BY window_start RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW))
SELECT product_id, window_start, pq / nullif(q, 0) AS vwap, rpq / nullif(rq, 0) AS rolling_vwap, rq::DOUBLE AS rolling_volume
FROM rolled""",
}
