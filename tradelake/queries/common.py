"""What the registered queries share: inputs, prepared lakes, SQL fragments."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.plans import bronze, gold, silver
from tradelake.plans.export import run_export
from tradelake.schemas import Layout
from tradelake.session import scratch_path
from tradelake.sources import tape
from tradelake.sources.wire import to_wire

FIRST_ARRIVAL = datetime(2024, 2, 1, tzinfo=UTC)
SECOND_ARRIVAL = datetime(2024, 2, 2, tzinfo=UTC)

# The same mapping of the event table onto trades, for the comparison SQL.
TRADES = """trades AS (
  SELECT CAST(event_id AS VARCHAR) AS trade_id, event_type AS product_id,
         CAST(value AS DECIMAL(18,8)) AS price,
         CAST((props->>'$.k') AS DECIMAL(18,8)) AS size,
         CAST((props->>'$.k') AS INTEGER) AS k,
         CASE WHEN event_type IN ('purchase','signup') THEN 'buy' ELSE 'sell' END AS side,
         ts AS traded_at, user_id
  FROM events)"""

LINES = """trades AS (
  SELECT concat(l_orderkey, '-', l_linenumber) AS trade_id, l_returnflag AS product_id,
         CAST(l_extendedprice AS DECIMAL(18,8)) AS price, CAST(l_quantity AS DECIMAL(18,8)) AS size,
         CASE WHEN l_linestatus = 'O' THEN 'buy' ELSE 'sell' END AS side, l_shipdate AS traded_at
  FROM lineitem)"""


def vwap_sql(unit: str, source: str = "trades", by: str = "") -> str:
    """SELECT of the published VWAP columns."""
    return f"""SELECT {by}date_trunc('{unit}', traded_at) AS window_start,
  sum(price::DECIMAL(20,8) * size) / nullif(sum(size), 0) AS vwap,
  sum(size)::DOUBLE AS total_volume, count(*) AS trade_count,
  max(price)::DOUBLE AS high_price, min(price)::DOUBLE AS low_price
FROM {source} GROUP BY ALL"""


def stats_sql(unit: str, source: str = "trades") -> str:
    """SELECT of the published statistics columns."""
    return f"""SELECT date_trunc('{unit}', traded_at) AS window_start,
  round(stddev(price), 6) AS volatility,
  count(*) FILTER (WHERE side = 'buy') AS buy_count,
  count(*) FILTER (WHERE side = 'sell') AS sell_count,
  (sum(CASE WHEN side = 'buy' THEN size ELSE 0 END) * 100.0) / nullif(sum(size), 0) AS buy_volume_pct
FROM {source} GROUP BY ALL"""


def comparable(df: DataFrame) -> DataFrame:
    """Zone-less UTC timestamps and doubles, the types the comparison reads."""
    out = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind == "timestamp":
            column = column.cast("timestamp_ntz")
        elif kind.startswith("decimal"):
            column = column.cast("double")
        elif name == "volatility":
            column = F.round(column, 6)
        out.append(column.alias(name))
    return df.select(*out)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return tape.table(spark, folder, "events")


def event_trades(spark: SparkSession, folder: str) -> DataFrame:
    return tape.event_trades(events(spark, folder))


def line_trades(spark: SparkSession, folder: str) -> DataFrame:
    return tape.line_trades(tape.table(spark, folder, "lineitem"))


def payloads(trades: DataFrame) -> DataFrame:
    """Wire messages only, as a broker hands them over."""
    return to_wire(trades).select("payload")


# Lakes written once per session and input folder, shared by the queries that
# read them.
_PREPARED: dict[tuple[str, str, str], Layout] = {}


def prepared(kind: str, build: Callable[[SparkSession, str, Layout], None], spark: SparkSession, folder: str) -> Layout:
    key = (spark.sparkContext.applicationId, folder, kind)
    if key not in _PREPARED:
        layout = Layout(scratch_path(spark, kind))
        build(spark, folder, layout)
        _PREPARED[key] = layout
    return _PREPARED[key]


def new_layout(spark: SparkSession, label: str) -> Layout:
    return Layout(scratch_path(spark, label))


def _whole_tape(spark: SparkSession, folder: str, layout: Layout) -> None:
    bronze.append(spark, layout, payloads(event_trades(spark, folder)), FIRST_ARRIVAL)
    silver.upsert(spark, layout, FIRST_ARRIVAL)
    gold.refresh(spark, layout, FIRST_ARRIVAL)
    run_export(spark, layout)


def whole_tape(spark: SparkSession, folder: str) -> Layout:
    """All events carried from bronze to the exported lake."""
    return prepared("tape", _whole_tape, spark, folder)


def second_delivery(spark: SparkSession, folder: str) -> DataFrame:
    """Late trades (the error events) and corrected purchases.

    A correction raises the price by one; for low user ids it also moves the
    trade one day on, into another partition.
    """
    rows = events(spark, folder)
    moved = F.when((F.col("event_type") == "purchase") & (F.col("user_id") < 40), F.expr("INTERVAL 1 DAY")).otherwise(F.expr("INTERVAL 0 DAY"))
    late = rows.filter(F.col("event_type").isin("error", "purchase"))
    trades = tape.event_trades(late.withColumn("ts", F.col("ts") + moved))
    lift = F.when(F.col("product_id") == "purchase", F.lit(1).cast("decimal(18,8)")).otherwise(F.lit(0).cast("decimal(18,8)"))
    return trades.withColumn("price", (F.col("price") + lift).cast("decimal(18,8)"))


def _two_deliveries(spark: SparkSession, folder: str, layout: Layout) -> None:
    first = events(spark, folder).filter("event_type <> 'error'")
    bronze.append(spark, layout, payloads(tape.event_trades(first)), FIRST_ARRIVAL, keep="all")
    silver.upsert(spark, layout, FIRST_ARRIVAL)
    gold.refresh(spark, layout, FIRST_ARRIVAL)
    run_export(spark, layout)
    bronze.append(spark, layout, payloads(second_delivery(spark, folder)), SECOND_ARRIVAL, keep="all")
    silver.upsert(spark, layout, SECOND_ARRIVAL)
    gold.refresh(spark, layout, SECOND_ARRIVAL)
    run_export(spark, layout)


def two_deliveries(spark: SparkSession, folder: str) -> Layout:
    """Events arriving in two deliveries, refreshed and exported after each."""
    return prepared("deliveries", _two_deliveries, spark, folder)


# What silver must hold after both deliveries.
DELIVERED = TRADES + """, delivered AS (
  SELECT trade_id, product_id,
         CASE WHEN product_id = 'purchase' THEN CAST(price + 1 AS DECIMAL(18,8)) ELSE price END AS price,
         size, side,
         CASE WHEN product_id = 'purchase' AND user_id < 40 THEN traded_at + INTERVAL 1 DAY ELSE traded_at END AS traded_at,
         CASE WHEN product_id IN ('purchase', 'error') THEN TIMESTAMP '2024-02-02 00:00:00'
              ELSE TIMESTAMP '2024-02-01 00:00:00' END AS ingested_at
  FROM trades)"""
