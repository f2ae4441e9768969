"""Bronze and silver."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tradelake.functions.windows import after_bookmark, bookmark_max
from tradelake.operators.dedup import latest
from tradelake.plans import bronze, silver
from tradelake.plans.packing import pack_bronze
from tradelake.queries.common import (
    DELIVERED, FIRST_ARRIVAL, LINES, SECOND_ARRIVAL, TRADES, comparable, event_trades, line_trades, new_layout,
    events, payloads, second_delivery, two_deliveries, whole_tape,
)
from tradelake.sources import tape
from tradelake.sources.tables import read_bronze, read_silver
from tradelake.sources.wire import to_wire

SILVER_OUT = ["trade_id", "product_id", "price", "size", "side", "traded_at", "ingested_at"]


def _wire(spark, folder):
    """Serialise, then read the text back as typed columns."""
    sent = to_wire(event_trades(spark, folder))
    back = sent.select(F.from_json("payload", "trade_id string, price string, size string, side string, time string, product_id string").alias("m"))
    return comparable(back.select(
        "m.trade_id", "m.product_id", F.col("m.price").cast("decimal(18,8)").alias("price"),
        F.col("m.size").cast("decimal(18,8)").alias("size"), "m.side", F.col("m.time").cast("timestamp").alias("traded_at"),
    ))


def _parse(spark, folder):
    """payload text -> typed columns, ids required."""
    return comparable(silver.parse(bronze.stamp(payloads(event_trades(spark, folder)), FIRST_ARRIVAL)))


def _dedup(spark, folder):
    return comparable(latest(line_trades(spark, folder), "trade_id", "traded_at", ["price", "size", "side", "product_id"]))


def _two_batches(spark, folder):
    """Order lines in two deliveries that overlap in ids: open lines, then all."""
    layout = new_layout(spark, "bronze")
    lines = line_trades(spark, folder)
    first = bronze.append(spark, layout, payloads(lines.filter("side = 'buy'")), FIRST_ARRIVAL)
    second = bronze.append(spark, layout, payloads(lines), SECOND_ARRIVAL)
    return layout, first, second


def _insert_if_absent(spark, folder):
    layout, _, _ = _two_batches(spark, folder)
    return comparable(read_bronze(spark, layout.bronze).select("trade_id", "received_at"))


def _skip_counts(spark, folder):
    _, first, second = _two_batches(spark, folder)
    rows = [(n, r.attempted, r.inserted, r.duplicates) for n, r in (("first", first), ("second", second))]
    return spark.createDataFrame(rows, "delivery string, attempted long, inserted long, skipped long")


def _bronze_scan(spark, folder):
    return comparable(read_bronze(spark, whole_tape(spark, folder).bronze).select("trade_id", "received_at", F.get_json_object("payload", "$.side").alias("side")))


def _arrivals(spark, folder):
    """Bookmark of one product's trades, then the rows past it (scalar subquery)."""
    rows = tape.table(spark, folder, "events")
    mark = bookmark_max(rows.filter("event_type = 'click' and value > 200"), "ts")
    return comparable(after_bookmark(rows, "ts", mark).select("event_id", "ts"))


def _committed_late(spark, folder):
    """The second delivery is committed after the first, but stamped two hours before it."""
    layout = new_layout(spark, "late-commit")
    first = tape.event_trades(events(spark, folder).filter("event_type <> 'error'"))
    for trades, stamp in ((first, FIRST_ARRIVAL), (second_delivery(spark, folder), FIRST_ARRIVAL - timedelta(hours=2))):
        bronze.append(spark, layout, payloads(trades), stamp, keep="all")
        silver.upsert(spark, layout, FIRST_ARRIVAL)
    return comparable(read_silver(spark, layout.silver).select(*SILVER_OUT))


def _packed(spark, folder):
    """The first delivery in four batches, packed once silver has them; the second comes twice, around a second packing."""
    layout = new_layout(spark, "packed")
    first = events(spark, folder).filter("event_type <> 'error'").withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(4)))
    for part in range(4):
        bronze.append(spark, layout, payloads(tape.event_trades(first.filter(F.col("part") == part))), FIRST_ARRIVAL, keep="all")
    silver.upsert(spark, layout, FIRST_ARRIVAL)
    pack_bronze(spark, layout)
    bronze.append(spark, layout, payloads(second_delivery(spark, folder)), SECOND_ARRIVAL, keep="all")
    silver.upsert(spark, layout, SECOND_ARRIVAL)
    pack_bronze(spark, layout)
    bronze.append(spark, layout, payloads(second_delivery(spark, folder)), SECOND_ARRIVAL)
    silver.rebuild(spark, layout, SECOND_ARRIVAL)
    arrivals = read_bronze(spark, layout.bronze).groupBy("trade_id").agg(F.count(F.lit(1)).alias("arrivals"))
    return comparable(read_silver(spark, layout.silver).join(arrivals, "trade_id").select(*SILVER_OUT, "arrivals"))


QUERIES = {
    "wire_serialise": _wire,
    "bronze_scan": _bronze_scan,
    "bronze_insert_if_absent": _insert_if_absent,
    "duplicate_skip_count": _skip_counts,
    "silver_parse_cast": _parse,
    "silver_dedup_latest": _dedup,
    "silver_incremental_upsert": lambda spark, folder: comparable(read_silver(spark, two_deliveries(spark, folder).silver).select(*SILVER_OUT)),
    "silver_committed_late": _committed_late,
    "bronze_packed": _packed,
    "bookmark_filter": _arrivals,
}

_TYPED = "trade_id, product_id, price::DOUBLE AS price, size::DOUBLE AS size, side, traded_at"

SQL = {
    "wire_serialise": f"WITH {TRADES} SELECT {_TYPED} FROM trades",
    "bronze_scan": f"WITH {TRADES} SELECT trade_id, TIMESTAMP '2024-02-01 00:00:00' AS received_at, side FROM trades",
    "bronze_insert_if_absent": f"""WITH {LINES}
SELECT trade_id, CASE WHEN bool_or(side = 'buy') THEN TIMESTAMP '2024-02-01 00:00:00'
  ELSE TIMESTAMP '2024-02-02 00:00:00' END AS received_at FROM trades GROUP BY trade_id""",
    "duplicate_skip_count": f"""WITH {LINES},
c AS (SELECT count(*) FILTER (WHERE side = 'buy') AS a1, count(DISTINCT trade_id) FILTER (WHERE side = 'buy') AS i1,
  count(*) AS a2, count(DISTINCT trade_id) AS ids FROM trades)
SELECT 'first' AS delivery, a1 AS attempted, i1 AS inserted, a1 - i1 AS skipped FROM c
UNION ALL SELECT 'second', a2, ids - i1, a2 - (ids - i1) FROM c""",
    "silver_parse_cast": f"WITH {TRADES} SELECT {_TYPED}, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at FROM trades",
    "silver_dedup_latest": f"""WITH {LINES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY trade_id
  ORDER BY traded_at DESC, price DESC, size DESC, side DESC, product_id DESC) AS n FROM trades)
SELECT {_TYPED} FROM ranked WHERE n = 1""",
    "silver_incremental_upsert": f"WITH {DELIVERED} SELECT {_TYPED}, ingested_at FROM delivered",
    "silver_committed_late": f"""WITH {TRADES} SELECT {_TYPED}, CASE WHEN product_id = 'error' THEN TIMESTAMP '2024-01-31 22:00:00'
  ELSE TIMESTAMP '2024-02-01 00:00:00' END AS ingested_at FROM trades""",
    "bronze_packed": f"""WITH {DELIVERED} SELECT {_TYPED}, ingested_at,
  CASE WHEN product_id = 'purchase' THEN 2 ELSE 1 END AS arrivals FROM delivered""",
    "bookmark_filter": """SELECT event_id, ts FROM events WHERE ts > (SELECT coalesce(max(ts), TIMESTAMP '1900-01-01 00:00:00')
  FROM events WHERE event_type = 'click' AND value > 200)""",
}
