"""Structured Streaming runs over the same tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradelake.plans import bronze, gold
from tradelake.queries.common import FIRST_ARRIVAL, TRADES, comparable, new_layout, payloads, vwap_sql
from tradelake.queries.feed import _LISTED
from tradelake.schemas import VWAP_TABLE
from tradelake.session import scratch_path
from tradelake.sources import tape
from tradelake.sources.tables import read_bronze, read_quarantine
from tradelake.streaming.ingest import start_ingest
from tradelake.streaming.late import dropped, repair
from tradelake.streaming.windows import dedup_stream, start_vwap, vwap_windows


def _trades(spark, folder):
    return tape.event_trades(tape.stream_table(spark, folder, "events"))


def _vwap(length):
    def query(spark, folder):
        layout = new_layout(spark, "stream-vwap")
        start_vwap(vwap_windows(_trades(spark, folder), length), layout, scratch_path(spark, "cp"), available_now=True).awaitTermination()
        return comparable(gold.published(spark, layout, VWAP_TABLE))
    return query


def _dedup(spark, folder):
    """Every trade delivered twice."""
    trades = _trades(spark, folder)
    out = scratch_path(spark, "stream-dedup")
    (
        comparable(dedup_stream(trades.unionByName(trades)))
        .writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "cp"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.parquet(out)


def _ingest(spark, folder):
    layout = new_layout(spark, "stream-ingest")
    lines = tape.frames(tape.stream_table(spark, folder, "events"))
    start_ingest(lines, layout, scratch_path(spark, "cp"), available_now=True).awaitTermination()
    return layout


def _stored(spark, folder):
    get = lambda name: F.get_json_object("payload", f"$.{name}").alias(name)
    return read_bronze(spark, _ingest(spark, folder).bronze).select("trade_id", get("side"), get("product_id"), get("price").cast("double").alias("price"))


def _set_aside(spark, folder):
    rows = read_quarantine(spark, _ingest(spark, folder).quarantine)
    return rows.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


def _late(spark, folder):
    """The earlier half of the tape arrives after the later one and is dropped; the repair puts it back."""
    layout, landing = new_layout(spark, "stream-late"), scratch_path(spark, "late-landing")
    rows = tape.table(spark, folder, "events")
    middle = rows.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.5).alias("at")).first()["at"]
    late = F.unix_micros(F.col("ts").cast("timestamp")) < middle
    # a batch drops what lies behind the watermark that the batch before it began with
    even = F.col("event_id") % 2 == 0
    bronze.append(spark, layout, payloads(tape.event_trades(rows)), FIRST_ARRIVAL)
    checkpoint, told = scratch_path(spark, "cp"), False
    for part, some in enumerate((~late & even, ~late & ~even, late)):  # a batch each, whatever the number of its files
        rows.filter(some).write.parquet(f"{landing}/{part}")
        arriving = spark.readStream.schema(rows.schema).parquet(f"{landing}/*")
        query = start_vwap(vwap_windows(tape.event_trades(arriving)), layout, checkpoint, available_now=True)
        query.awaitTermination()
        told = told or dropped(query) > 0
    repair(spark, layout, FIRST_ARRIVAL)
    return comparable(gold.published(spark, layout, VWAP_TABLE)).withColumn("late_told", F.lit(told))


QUERIES = {
    "stream_vwap": _vwap("1 minute"),
    "stream_vwap_hour": _vwap("1 hour"),
    "stream_dedup": _dedup,
    "stream_late_repaired": _late,
    "stream_ingest": _stored,
    "stream_quarantine": _set_aside,
}

SQL = {
    "stream_vwap": f"WITH {TRADES} {vwap_sql('minute')}",
    "stream_vwap_hour": f"WITH {TRADES} {vwap_sql('hour')}",
    "stream_late_repaired": f"WITH {TRADES} SELECT *, true AS late_told FROM ({vwap_sql('minute')})",
    "stream_dedup": f"WITH {TRADES} SELECT trade_id, product_id, price::DOUBLE AS price, size::DOUBLE AS size, side, traded_at FROM trades",
    "stream_ingest": f"""WITH {TRADES}, {_LISTED}
SELECT f.* FROM flat f JOIN trades t ON replace(f.trade_id, '-m', '') = t.trade_id WHERE t.k > 0 AND t.price > 0""",
    "stream_quarantine": f"""WITH {TRADES}, {_LISTED}
SELECT 'frame_not_json' AS reason, count(*) AS records FROM trades WHERE product_id = 'error' AND k < 30 HAVING count(*) > 0
UNION ALL SELECT 'frame_not_object', count(*) FROM trades WHERE product_id = 'click' AND k >= 10 AND k < 20 HAVING count(*) > 0
UNION ALL SELECT 'size_not_positive', 2 * count(*) FROM listed WHERE k = 0 HAVING count(*) > 0
UNION ALL SELECT 'price_not_positive', 2 * count(*) FROM listed WHERE price <= 0 HAVING count(*) > 0""",
}
