"""What commits by number promise: any order of stamps, writers and failures ends in the same tables."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from tradelake.operators.metrics import published_vwap, vwap
from tradelake.plans import bronze, gold, silver
from tradelake.plans.export import row_count, run_export
from tradelake.queries.common import (
    DELIVERED, FIRST_ARRIVAL, SECOND_ARRIVAL, TRADES, comparable, event_trades, events, new_layout, payloads, second_delivery, vwap_sql,
)
from tradelake.schemas import DATE_PARTS, SILVER, VWAP_TABLE, Layout
from tradelake.session import scratch_path
from tradelake.sources import snapshots, tape
from tradelake.sources.files import claim, delete
from tradelake.sources.tables import read_gold, read_silver, union_by_name
from tradelake.streaming.windows import start_vwap, vwap_windows


def _first(spark, folder):
    return payloads(tape.event_trades(events(spark, folder).filter("event_type <> 'error'")))


def _run(spark, layout, batch, arrived, run_at, **options):
    bronze.append(spark, layout, batch, arrived, keep="all")
    silver.upsert(spark, layout, run_at)
    gold.refresh(spark, layout, run_at)
    run_export(spark, layout, **options)


def _lake(spark, layout):
    return comparable(read_gold(spark, layout.lake(VWAP_TABLE), VWAP_TABLE).drop(*DATE_PARTS))


def _slots(first, second):
    """Two runs whose schedule slots are ``first`` and ``second``."""
    def query(spark, folder):
        layout = new_layout(spark, "slots")
        _run(spark, layout, _first(spark, folder), FIRST_ARRIVAL, first)
        _run(spark, layout, payloads(second_delivery(spark, folder)), SECOND_ARRIVAL, second)
        return _lake(spark, layout)
    return query


def _stream_and_batch(spark, folder):
    """A batch run stamped far ahead of the clock, then a stream over all events, then an export."""
    layout = new_layout(spark, "mixed")
    _run(spark, layout, _first(spark, folder), FIRST_ARRIVAL, datetime(2099, 1, 1, tzinfo=UTC))
    trades = tape.event_trades(tape.stream_table(spark, folder, "events"))
    start_vwap(vwap_windows(trades), layout, scratch_path(spark, "cp"), available_now=True).awaitTermination()
    run_export(spark, layout)
    return _lake(spark, layout)


def _interrupted(spark, folder):
    """A run writes silver's rows and dies before its commit; readers go on, then the slot runs again."""
    layout = new_layout(spark, "interrupted")
    _run(spark, layout, _first(spark, folder), FIRST_ARRIVAL, FIRST_ARRIVAL)
    second = payloads(second_delivery(spark, folder))
    bronze.append(spark, layout, second, SECOND_ARRIVAL, keep="all")
    rows = silver.latest_trades(silver.parse(bronze.stamp(second, SECOND_ARRIVAL)))
    rows = rows.withColumn("trade_date", F.to_date("traded_at")).select(*SILVER.names)
    snapshots.write(rows, layout.silver, "trade_date", ["traded_at"], "traded_at")
    gold.refresh(spark, layout, SECOND_ARRIVAL)
    run_export(spark, layout)
    silver.upsert(spark, layout, SECOND_ARRIVAL)
    gold.refresh(spark, layout, SECOND_ARRIVAL)
    run_export(spark, layout)
    return _lake(spark, layout)


def _null_time(spark, folder):
    """Small sign-ups carry no time; their window outlives an incremental export."""
    layout = new_layout(spark, "null-time")
    rows = events(spark, folder)
    timeless = (F.col("event_type") == "signup") & (F.get_json_object("props", "$.k").cast("int") < 10)
    rows = rows.withColumn("ts", F.when(~timeless, F.col("ts")))
    for kind, stamp in (("event_type <> 'error'", FIRST_ARRIVAL), ("event_type = 'error'", SECOND_ARRIVAL)):
        _run(spark, layout, payloads(tape.event_trades(rows.filter(kind))), stamp, stamp)
    return _lake(spark, layout)


def _emptied(spark, folder):
    """Windows in silver, gold and lake before and after bronze was emptied and all rebuilt."""
    layout = new_layout(spark, "emptied")
    _run(spark, layout, payloads(event_trades(spark, folder)), FIRST_ARRIVAL, FIRST_ARRIVAL)
    count = lambda: (read_silver(spark, layout.silver).count(), gold.read(spark, layout, VWAP_TABLE).count(), row_count(spark, layout, VWAP_TABLE))
    before = count()
    delete(spark, layout.bronze)
    silver.rebuild(spark, layout, SECOND_ARRIVAL)
    gold.rebuild(spark, layout, SECOND_ARRIVAL)
    run_export(spark, layout)
    rows = [("before", *before), ("after", *count())]
    return spark.createDataFrame(rows, "moment string, trades long, windows long, exported long")


def _replica(spark, folder):
    """The replica of a table whose first copy failed and whose days then moved."""
    layout = new_layout(spark, "replicated")
    blocked = scratch_path(spark, "blocked")
    claim(spark, blocked)
    replica = Layout(scratch_path(spark, "replica"))
    _run(spark, layout, _first(spark, folder), FIRST_ARRIVAL, FIRST_ARRIVAL, replica=f"{blocked}/below")
    _run(spark, layout, payloads(second_delivery(spark, folder)), SECOND_ARRIVAL, SECOND_ARRIVAL, replica=replica.base)
    return _lake(spark, replica)


def _widened(spark, folder):
    """Hour windows in files of three versions: counts as int, long and none, prices as two decimals and double."""
    root = new_layout(spark, "widened").base
    hours = comparable(published_vwap(vwap(event_trades(spark, folder), "hour")))
    low = F.col("low_price")
    hours.filter(low < 2).select(
        "window_start", F.col("trade_count").cast("int").alias("trade_count"), low.cast("decimal(10,2)").alias("low_price")).write.parquet(f"{root}/part=0")
    hours.filter((low >= 2) & (low < 20)).select(
        "window_start", "trade_count", low.cast("decimal(18,8)").alias("low_price"), "high_price").write.parquet(f"{root}/part=1")
    hours.filter(low >= 20).select("high_price", "window_start", low).write.parquet(f"{root}/part=2")
    return comparable(union_by_name(spark, root).select("window_start", "trade_count", "low_price", "high_price"))


QUERIES = {
    "commit_same_slot": _slots(FIRST_ARRIVAL, FIRST_ARRIVAL),
    "commit_older_slot": _slots(SECOND_ARRIVAL, FIRST_ARRIVAL - timedelta(days=3)),
    "commit_stream_and_batch": _stream_and_batch,
    "commit_interrupted": _interrupted,
    "commit_null_time": _null_time,
    "commit_emptied_source": _emptied,
    "replica_after_failure": _replica,
    "union_by_name_types": _widened,
}

_DELIVERED = f"WITH {DELIVERED} {vwap_sql('minute', 'delivered')}"

SQL = {
    "commit_same_slot": _DELIVERED,
    "commit_older_slot": _DELIVERED,
    "commit_stream_and_batch": f"WITH {TRADES} {vwap_sql('minute')}",
    "commit_interrupted": _DELIVERED,
    "commit_null_time": f"""WITH {TRADES}, timeless AS (SELECT * REPLACE
  (CASE WHEN product_id = 'signup' AND k < 10 THEN NULL ELSE traded_at END AS traded_at) FROM trades)
{vwap_sql('minute', 'timeless')}""",
    "commit_emptied_source": f"""WITH {TRADES}, w AS (SELECT DISTINCT date_trunc('minute', traded_at) AS m FROM trades)
SELECT 'before' AS moment, (SELECT count(*) FROM trades) AS trades, count(*) AS windows, count(*) AS exported FROM w
UNION ALL SELECT 'after', 0, 0, 0""",
    "replica_after_failure": _DELIVERED,
    "union_by_name_types": f"""WITH {TRADES}, w AS ({vwap_sql('hour')})
SELECT window_start, CASE WHEN low_price < 20 THEN trade_count END AS trade_count, low_price,
  CASE WHEN low_price >= 2 THEN high_price END AS high_price FROM w""",
}
