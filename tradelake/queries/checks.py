"""Data-quality checks."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tradelake.operators import quality
from tradelake.operators.metrics import trade_stats, vwap
from tradelake.plans.refresh import quality_report
from tradelake.queries.common import LINES, SECOND_ARRIVAL, TRADES, comparable, event_trades, events, line_trades, two_deliveries


def _null_vwap(spark, folder):
    windows = vwap(event_trades(spark, folder))
    return comparable(quality.run("not_null", windows, column="vwap").select("window_start", "trade_count"))


def _band(windows):
    """Hour windows with a made-up upper bound, so that some leave it."""
    return windows.withColumn("ceiling", (F.col("low_price") + F.lit(60).cast("decimal(2,0)")).cast("decimal(18,8)"))


def _bounds(high):
    def query(spark, folder):
        windows = _band(vwap(event_trades(spark, folder), "hour"))
        failing = quality.run("vwap_bounds", windows, vwap="vwap_exact", high=high, low="low_price")
        return comparable(failing.select("window_start", "low_price", "trade_count"))
    return query


def _minute_bounds(spark, folder):
    windows = vwap(event_trades(spark, folder))
    return quality.run("vwap_bounds", windows, vwap="vwap_exact", high="high_price", low="low_price").agg(F.count(F.lit(1)).alias("failures"))


def _freshness(spark, folder):
    """One status per event type, as of the newest event of all."""
    rows = events(spark, folder)
    newest = rows.agg(F.max("ts").cast("timestamp").alias("m")).scalar()
    return comparable(quality.freshness(rows, "ts", newest + F.expr("INTERVAL 45 MINUTES"), timedelta(minutes=60), timedelta(hours=2), ["event_type"]))


def _pct_sum(spark, folder):
    """Hours of a tape whose views have no side: their volume is in neither share."""
    sided = event_trades(spark, folder).withColumn("side", F.when(F.col("product_id") != "view", F.col("side")))
    stats = trade_stats(sided, "hour")
    off = quality.run("pct_sum", stats, buy="buy_volume_pct", sell="sell_volume_pct")
    return comparable(off.select("window_start", "buy_count", "sell_count"))


def _report(table):
    return table.select(F.col("table").alias("table_name"), F.col("check").alias("check_name"), F.col("column").alias("column_name"), "failures", "status")


def _stale_report(spark, folder):
    """All checks of the whole tape, 45 minutes after its arrival."""
    return _report(quality_report(spark, two_deliveries(spark, folder), as_of=SECOND_ARRIVAL + timedelta(minutes=45)))


QUERIES = {
    "check_not_null": _null_vwap,
    "check_unique": lambda spark, folder: quality.run("unique", line_trades(spark, folder), column="trade_id"),
    "check_accepted_values": lambda spark, folder: quality.run("accepted_values", events(spark, folder), column="event_type",
                                                               values=["click", "view", "purchase", "signup"]).select("event_id", "event_type"),
    "check_range": lambda spark, folder: comparable(quality.run("between", event_trades(spark, folder), column="price", low="1.00", high="150").select("trade_id", "price")),
    "check_vwap_bounds": _minute_bounds,
    "check_vwap_ceiling": _bounds("ceiling"),
    "check_freshness": _freshness,
    "check_pct_sum": _pct_sum,
    "quality_report": lambda spark, folder: _report(quality_report(spark, two_deliveries(spark, folder))),
    "quality_report_stale": _stale_report,
}

_SUITE = [
    ("stg_trades", "unique", "trade_id", "0"),
    *[("stg_trades", "not_null", c, "0") for c in ("trade_id", "price", "size", "side", "traded_at", "ingested_at")],
    ("stg_trades", "accepted_values", "side", "0"),
    ("stg_trades", "between", "price", "(SELECT count(*) FROM delivered WHERE price NOT BETWEEN 0.00000001 AND 1000000)"),
    ("gold_vwap_1min", "unique", "window_start", "0"),
    *[("gold_vwap_1min", "not_null", c, "0") for c in ("window_start", "total_volume", "trade_count", "high_price", "low_price")],
    ("gold_vwap_1min", "not_null", "vwap", "(SELECT count(*) FROM w WHERE v = 0)"),
    ("gold_vwap_1min", "vwap_bounds", "vwap", "0"),
    ("gold_trade_stats_1min", "unique", "window_start", "0"),
    ("gold_trade_stats_1min", "not_null", "window_start", "0"),
    ("gold_trade_stats_1min", "between", "buy_volume_pct", "0"),
    ("gold_trade_stats_1min", "pct_sum", "buy_volume_pct", "0"),
]


def _report_sql() -> str:
    from tradelake.queries.common import DELIVERED

    rows = "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{k}' AS check_name, '{c}' AS column_name, CAST({n} AS BIGINT) AS failures" for t, k, c, n in _SUITE
    )
    return f"""WITH {DELIVERED}, w AS (SELECT date_trunc('minute', traded_at) AS m, sum(size) AS v FROM delivered GROUP BY ALL),
r AS ({rows}) SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM r"""


_HOURS = """hours AS (SELECT date_trunc('hour', traded_at) AS window_start, sum(price::DECIMAL(20,8) * size) AS pq,
  sum(size) AS q, min(price) AS low, max(price) AS high, count(*) AS trade_count FROM trades GROUP BY ALL)"""

SQL = {
    "check_not_null": f"WITH {TRADES} SELECT date_trunc('minute', traded_at) AS window_start, count(*) AS trade_count FROM trades GROUP BY ALL HAVING sum(size) = 0",
    "check_unique": f"WITH {LINES} SELECT trade_id, count(*) AS occurrences FROM trades GROUP BY trade_id HAVING count(*) > 1",
    "check_accepted_values": "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view', 'purchase', 'signup')",
    "check_range": f"WITH {TRADES} SELECT trade_id, price::DOUBLE AS price FROM trades WHERE price NOT BETWEEN 1.00 AND 150",
    "check_vwap_bounds": "SELECT CAST(0 AS BIGINT) AS failures",
    "check_vwap_ceiling": f"""WITH {TRADES}, {_HOURS}
SELECT window_start, low::DOUBLE AS low_price, trade_count FROM hours
WHERE q > 0 AND pq > CAST(low + 60 AS DECIMAL(18,8)) * CAST(q AS DECIMAL(20,8))""",
    "check_freshness": """WITH n AS (SELECT event_type, max(ts) AS newest, (SELECT max(ts) + INTERVAL 45 MINUTES FROM events) AS as_of FROM events GROUP BY event_type)
SELECT *, CASE WHEN as_of - newest > INTERVAL 2 HOURS THEN 'error' WHEN as_of - newest > INTERVAL 60 MINUTES THEN 'warn' ELSE 'pass' END AS status FROM n""",
    "check_pct_sum": f"""WITH {TRADES}, h AS (SELECT date_trunc('hour', traded_at) AS window_start, sum(size)::DOUBLE AS v,
  coalesce(sum(size) FILTER (WHERE side = 'buy' AND product_id <> 'view'), 0)::DOUBLE AS b, coalesce(sum(size) FILTER (WHERE side = 'sell' AND product_id <> 'view'), 0)::DOUBLE AS s,
  count(*) FILTER (WHERE side = 'buy' AND product_id <> 'view') AS buy_count, count(*) FILTER (WHERE side = 'sell' AND product_id <> 'view') AS sell_count FROM trades GROUP BY ALL)
SELECT window_start, buy_count, sell_count FROM h WHERE v > 0 AND abs(100 * b / v + 100 * s / v - 100) > 0.001""",
    "quality_report": _report_sql(),
    "quality_report_stale": _report_sql() + " UNION ALL SELECT 'raw_trades', 'freshness', 'received_at', 1, 'warn'",
}
# Each window's VWAP against its own bounds, exactly, in integers of 1e-16.
SQL["check_vwap_bounds"] = f"""WITH {TRADES}, w AS (SELECT date_trunc('minute', traded_at) AS m, sum(price::DECIMAL(20,8) * size) AS pq,
  CAST(sum(size) AS DECIMAL(20,8)) AS q, min(price) AS low, max(price) AS high FROM trades GROUP BY ALL)
SELECT count(*) AS failures FROM w WHERE q > 0 AND (pq < low * q OR pq > high * q)"""
