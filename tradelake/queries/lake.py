"""Export, views and dashboards."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tradelake.functions.windows import from_micros
from tradelake.plans import dashboards, refresh, state
from tradelake.plans.export import row_count
from tradelake.queries.common import (
    DELIVERED, FIRST_ARRIVAL, TRADES, comparable, event_trades, new_layout, payloads, stats_sql, two_deliveries, vwap_sql, whole_tape,
)
from tradelake.plans import bronze
from tradelake.operators.metrics import published_vwap, vwap
from tradelake.schemas import DATE_PARTS, STATS_TABLE, VWAP_TABLE
from tradelake.sources.catalog import register_views
from tradelake.sources.tables import read_gold, union_by_name


def _view(view):
    def query(spark, folder):
        register_views(spark, whole_tape(spark, folder))
        return comparable(spark.table(view).drop(*DATE_PARTS))
    return query


def _incremental(table):
    """The lake after a first and a second export equals the final gold."""
    return lambda spark, folder: comparable(read_gold(spark, two_deliveries(spark, folder).lake(table), table).drop(*DATE_PARTS))


def _partitions(spark, folder):
    lake = read_gold(spark, whole_tape(spark, folder).lake(VWAP_TABLE), VWAP_TABLE)
    return lake.groupBy(*DATE_PARTS).agg(F.count(F.lit(1)).alias("windows"))


def _row_counts(spark, folder):
    layout = whole_tape(spark, folder)
    rows = [(table, row_count(spark, layout, table)) for table in (VWAP_TABLE, STATS_TABLE)]
    return spark.createDataFrame(rows, "table_name string, row_total long")


def _state(spark, folder):
    return comparable(state.read_export_state(spark, two_deliveries(spark, folder)).select("table_name", "last_exported_at", "rows_total"))


def _newest(spark, layout, table):
    """Newest exported window: one aggregate, one value."""
    return from_micros(read_gold(spark, layout.lake(table), table).agg(F.unix_micros(F.max("window_start")).alias("at")).first().at)


def _recent(chart):
    def query(spark, folder):
        layout = whole_tape(spark, folder)
        as_of = _newest(spark, layout, dashboards.CHARTS[chart][0]) + timedelta(minutes=1)
        return comparable(dashboards.recent(spark, layout, chart, as_of=as_of, minutes=60 * 24))
    return query


def _latest(chart):
    return lambda spark, folder: comparable(dashboards.latest(spark, whole_tape(spark, folder), chart, 5))


def _since(spark, folder):
    """Windows past a bookmark, with directories before its day pruned."""
    layout = whole_tape(spark, folder)
    since = _newest(spark, layout, VWAP_TABLE) - timedelta(days=3)
    return comparable(read_gold(spark, layout.lake(VWAP_TABLE), VWAP_TABLE, since=since).drop(*DATE_PARTS))


def _schema_versions(spark, folder):
    """Hour windows stored by two schema versions, read as one table."""
    root = new_layout(spark, "versions").lake(VWAP_TABLE)
    hours = comparable(published_vwap(vwap(event_trades(spark, folder), "hour")))
    early = F.col("low_price") < 2
    hours.filter(early).drop("trade_count").write.mode("append").parquet(root)
    hours.filter(~early).write.mode("append").parquet(root)
    return union_by_name(spark, root).select(*hours.columns)


def _gated(spark, folder):
    """A gated run over the whole tape: zero-volume windows block the export."""
    layout = new_layout(spark, "gated")
    bronze.append(spark, layout, payloads(event_trades(spark, folder)), FIRST_ARRIVAL)
    done = refresh.refresh(spark, layout, FIRST_ARRIVAL)
    failures = sum(check["failures"] for check in done.failed_checks)
    row = (done.published, failures, done.changed_rows, row_count(spark, layout, VWAP_TABLE))
    return spark.createDataFrame([row], "published boolean, failures long, trades long, exported long")


CHART_NAMES = list(dashboards.CHARTS)

QUERIES = {
    "export_roundtrip": _view("vw_vwap_1min"),
    "export_roundtrip_stats": _view("vw_trade_stats_1min"),
    "export_incremental": _incremental(VWAP_TABLE),
    "export_incremental_stats": _incremental(STATS_TABLE),
    "export_partitions": _partitions,
    "export_state": _state,
    "dataset_row_count": _row_counts,
    "gold_since": _since,
    "union_by_name_view": _schema_versions,
    "refresh_gated": _gated,
    **{f"dash_{chart}_recent": _recent(chart) for chart in CHART_NAMES},
    **{f"dash_{chart}_latest5": _latest(chart) for chart in CHART_NAMES},
}

_VWAP = f"w AS ({vwap_sql('minute')})"
_STATS = f"w AS ({stats_sql('minute')})"
_CHART_SQL = {
    "vwap": (_VWAP, "window_start, vwap"),
    "volume": (_VWAP, "window_start, total_volume"),
    "pressure": (_STATS, "window_start, buy_volume_pct, 100 - buy_volume_pct AS sell_volume_pct"),
    "volatility": (_STATS, "window_start, volatility"),
}

SQL = {
    "export_roundtrip": f"WITH {TRADES} {vwap_sql('minute')}",
    "export_roundtrip_stats": f"WITH {TRADES} {stats_sql('minute')}",
    "export_incremental": f"WITH {DELIVERED} {vwap_sql('minute', 'delivered')}",
    "export_incremental_stats": f"WITH {DELIVERED} {stats_sql('minute', 'delivered')}",
    "export_partitions": f"""WITH {TRADES}, {_VWAP} SELECT strftime(window_start, '%Y') AS year, strftime(window_start, '%m') AS month,
  strftime(window_start, '%d') AS day, count(*) AS windows FROM w GROUP BY ALL""",
    "export_state": f"""WITH {DELIVERED}, w AS (SELECT DISTINCT date_trunc('minute', traded_at) AS m FROM delivered),
n AS (SELECT count(*) AS rows_total, TIMESTAMP '2024-02-02 00:00:00' AS last_exported_at FROM w)
SELECT 'gold_vwap_1min' AS table_name, last_exported_at, rows_total FROM n
UNION ALL SELECT 'gold_trade_stats_1min', last_exported_at, rows_total FROM n""",
    "dataset_row_count": f"""WITH {TRADES}, w AS (SELECT DISTINCT date_trunc('minute', traded_at) AS m FROM trades)
SELECT 'gold_vwap_1min' AS table_name, count(*) AS row_total FROM w UNION ALL SELECT 'gold_trade_stats_1min', count(*) FROM w""",
    "gold_since": f"WITH {TRADES}, {_VWAP} SELECT * FROM w WHERE window_start > (SELECT max(window_start) - INTERVAL 3 DAYS FROM w)",
    "union_by_name_view": f"""WITH {TRADES}, w AS ({vwap_sql('hour')})
SELECT window_start, vwap, total_volume, CASE WHEN low_price < 2 THEN NULL ELSE trade_count END AS trade_count, high_price, low_price FROM w""",
    "refresh_gated": f"""WITH {TRADES}, w AS (SELECT date_trunc('minute', traded_at) AS m, sum(size) AS v FROM trades GROUP BY ALL),
f AS (SELECT count(*) FILTER (WHERE v = 0) + (SELECT count(*) FROM trades WHERE price NOT BETWEEN 0.00000001 AND 1000000) AS failures,
  count(*) AS windows FROM w)
SELECT failures = 0 AS published, failures, (SELECT count(*) FROM trades) AS trades, CASE WHEN failures = 0 THEN windows ELSE 0 END AS exported FROM f""",
    **{f"dash_{name}_recent": f"""WITH {TRADES}, {cte} SELECT {columns} FROM w
WHERE window_start > (SELECT max(window_start) + INTERVAL 1 MINUTE - INTERVAL 24 HOURS FROM w) ORDER BY window_start"""
       for name, (cte, columns) in _CHART_SQL.items()},
    **{f"dash_{name}_latest5": f"WITH {TRADES}, {cte} SELECT {columns} FROM w ORDER BY window_start DESC LIMIT 5"
       for name, (cte, columns) in _CHART_SQL.items()},
}
