"""Feed frames and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradelake.operators.flatten import flatten, of_products
from tradelake.operators.validate import accepted, health_counts, reason_counts, rejected, validate
from tradelake.plans.packing import pack_quarantine
from tradelake.plans.quarantine import quarantine
from tradelake.queries.common import FIRST_ARRIVAL, TRADES, comparable, events, new_layout
from tradelake.sources import tape
from tradelake.sources.feed import bad_frames, parse_frames
from tradelake.sources.tables import read_quarantine


def _flat(spark, folder):
    return flatten(tape.frames(events(spark, folder)))


def _members(trades):
    get = lambda name: F.try_variant_get("trade", f"$.{name}", "string").alias(name)
    return trades.select(get("trade_id"), get("side"), get("product_id"), F.try_variant_get("trade", "$.price", "double").alias("price"))


def _checked(spark, folder):
    lines = tape.faulty_json(events(spark, folder))
    return validate(lines.select(F.try_parse_json("raw").alias("trade")))


def _set_aside(spark, folder):
    """Rejected records set aside, again under the same batch as a replay does, and read back."""
    layout = new_layout(spark, "set-aside")
    rows = rejected(_checked(spark, folder)).withColumns({"received_at": F.lit(FIRST_ARRIVAL), "batch_id": F.lit("batch-1")})
    for _ in range(2):
        quarantine(rows, layout)
    return _by_reasons(read_quarantine(spark, layout.quarantine))


def _packed(spark, folder):
    """Rejected records of many batches, packed; the last batch comes again, then all are packed again."""
    layout = new_layout(spark, "set-aside-packed")
    number = F.pmod(F.xxhash64("raw"), F.lit(20)).cast("string")
    rows = rejected(_checked(spark, folder)).withColumns(
        {"received_at": F.lit(FIRST_ARRIVAL), "batch_id": F.concat(F.lit("feed-"), F.lpad(number, 12, "0"))})
    quarantine(rows, layout)
    pack_quarantine(spark, layout)
    quarantine(rows.filter(number.cast("int") >= 18), layout)
    pack_quarantine(spark, layout)
    return _by_reasons(read_quarantine(spark, layout.quarantine))


def _by_reasons(aside):
    kept = aside.select(F.length("raw").alias("_n"), F.size("reasons").alias("broken"))
    return kept.groupBy("broken").agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("_n") > 0).alias("with_text"))


QUERIES = {
    "feed_flatten": lambda spark, folder: _members(_flat(spark, folder)),
    "feed_bad_frames": lambda spark, folder: bad_frames(parse_frames(tape.frames(events(spark, folder)))).select("raw", F.col("reasons")[0].alias("reason")),
    "feed_products": lambda spark, folder: _members(of_products(_flat(spark, folder), ["signup", "view"])),
    "validate_accept": lambda spark, folder: comparable(accepted(_checked(spark, folder))),
    "validate_reject_reasons": lambda spark, folder: rejected(_checked(spark, folder)).select(
        F.try_variant_get(F.parse_json("raw"), "$.time", "string").alias("time"), F.array_join("reasons", ",").alias("reasons")),
    "feed_health_counts": lambda spark, folder: health_counts(_checked(spark, folder)),
    "reject_counts": lambda spark, folder: reason_counts(_checked(spark, folder)),
    "quarantine_rows": _set_aside,
    "quarantine_packed": _packed,
}

_LISTED = """listed AS (SELECT * FROM trades WHERE NOT (
  (product_id = 'error' AND k < 30) OR (product_id = 'view' AND k < 20) OR (product_id = 'click' AND k < 20))),
flat AS (SELECT trade_id, side, product_id, price::DOUBLE AS price FROM listed
  UNION ALL SELECT trade_id || '-m', CASE WHEN side = 'buy' THEN 'sell' ELSE 'buy' END, product_id, price::DOUBLE FROM listed)"""

# The rules in the order they are listed; real prices and sizes may be zero too.
_STATUS = """status AS (SELECT *, concat_ws(',',
  CASE k WHEN 1 THEN 'trade_id_empty' WHEN 10 THEN 'trade_id_not_text' END,
  CASE WHEN k = 3 THEN 'price_not_positive' WHEN k = 6 THEN 'price_is_float' WHEN k = 9 THEN 'price_missing'
       WHEN k = 11 THEN 'price_out_of_range' WHEN price <= 0 THEN 'price_not_positive' END,
  CASE WHEN k = 4 OR size <= 0 THEN 'size_not_positive' END,
  CASE k WHEN 2 THEN 'side_unknown' WHEN 8 THEN 'side_not_text' END,
  CASE k WHEN 5 THEN 'time_without_zone' END) AS reasons FROM trades)"""

SQL = {
    "feed_flatten": f"WITH {TRADES}, {_LISTED} SELECT * FROM flat",
    "feed_bad_frames": f"""WITH {TRADES}
SELECT '{{"channel":"market_trades","events":[' || trade_id AS raw, 'frame_not_json' AS reason FROM trades WHERE product_id = 'error' AND k < 30
UNION ALL SELECT '[1,2,3]', 'frame_not_object' FROM trades WHERE product_id = 'click' AND k >= 10 AND k < 20""",
    "feed_products": f"WITH {TRADES}, {_LISTED} SELECT * FROM flat WHERE product_id IN ('signup', 'view')",
    "validate_accept": f"""WITH {TRADES}, {_STATUS}
SELECT trade_id, product_id, price::DOUBLE AS price, size::DOUBLE AS size, side, traded_at FROM status WHERE reasons = ''""",
    "validate_reject_reasons": f"""WITH {TRADES}, {_STATUS}
SELECT strftime(traded_at, '%Y-%m-%dT%H:%M:%S.%f') || CASE WHEN k = 5 THEN '' ELSE 'Z' END AS time, reasons
FROM status WHERE reasons <> ''""",
    "feed_health_counts": f"""WITH {TRADES}, {_STATUS}
SELECT count(*) AS received, count(*) FILTER (WHERE reasons = '') AS valid, count(*) FILTER (WHERE reasons <> '') AS invalid FROM status""",
    "reject_counts": f"""WITH {TRADES}, {_STATUS}
SELECT reason, count(*) AS records FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM status WHERE reasons <> '') GROUP BY reason""",
    "quarantine_rows": f"""WITH {TRADES}, {_STATUS}
SELECT CAST(len(string_split(reasons, ',')) AS INTEGER) AS broken, count(*) AS records, count(*) AS with_text FROM status WHERE reasons <> '' GROUP BY ALL""",
}
SQL["quarantine_packed"] = SQL["quarantine_rows"]
