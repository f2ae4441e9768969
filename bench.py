"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Reads run once to warm up and then $BENCH_RUNS times, the median counts; streams run
once after the warm-up; of two passes of the write steps the better one counts.
Read-side queries are drained to a no-op sink, write-side ones write a new lake.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tradelake.plans import bronze, gold, silver  # noqa: E402
from tradelake.plans.export import run_export  # noqa: E402
from tradelake.queries import common, queries  # noqa: E402
from tradelake.operators.flatten import flatten  # noqa: E402
from tradelake.operators.validate import validate  # noqa: E402
from tradelake.session import configure, scratch_path  # noqa: E402
from tradelake.sources import tape  # noqa: E402
from tradelake.sources.feed import read_frames  # noqa: E402
from tradelake.streaming.ingest import ingest_frames  # noqa: E402

READS = [
    "gold_vwap_minute", "gold_vwap_hour", "gold_vwap_lineitem_day", "gold_trade_stats_minute", "rolling_vwap",
    "silver_parse_cast", "silver_dedup_latest", "wire_serialise",
    "feed_flatten", "validate_accept", "feed_health_counts",
    "check_unique", "check_vwap_bounds", "quality_report",
    "export_roundtrip", "gold_since",
    "dash_vwap_recent", "dash_volume_recent", "dash_pressure_recent", "dash_volatility_recent",
    "dash_vwap_latest5", "dash_volume_latest5", "dash_pressure_latest5", "dash_volatility_latest5",
]
STREAMS = ["stream_vwap", "stream_dedup"]
LINE_QUERIES = {"gold_vwap_lineitem_day", "silver_dedup_latest", "check_unique"}


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def landed_frames(spark, folder: str):
    """The event table as feed lines in text files, written once."""
    path = scratch_path(spark, "bench-frames")
    tape.frames(common.events(spark, folder)).write.text(path)
    return read_frames(spark, path)


def landed(messages):
    """Messages as a broker hands them over: spread over its partitions."""
    path = scratch_path(messages.sparkSession, "bench-messages")
    messages.repartition(8).write.parquet(path)
    return messages.sparkSession.read.parquet(path)


def layered_run(spark, folder: str, frames) -> dict[str, float]:
    """One pass bronze -> silver -> gold -> lake, then a second delivery."""
    layout = common.new_layout(spark, "bench")
    trades = landed(common.payloads(common.event_trades(spark, folder)))
    again = landed(common.payloads(common.second_delivery(spark, folder)))
    first, second = common.FIRST_ARRIVAL, common.SECOND_ARRIVAL
    return {
        "write_bronze_append": timed(lambda: bronze.append(spark, layout, trades, first)),
        "write_bronze_redelivery": timed(lambda: bronze.append(spark, layout, trades, first)),
        "write_silver_rebuild": timed(lambda: silver.upsert(spark, layout, first)),
        "write_gold_rebuild": timed(lambda: gold.refresh(spark, layout, first)),
        "write_export_full": timed(lambda: run_export(spark, layout)),
        "write_bronze_corrections": timed(lambda: bronze.append(spark, layout, again, second, keep="all")),
        "write_silver_upsert": timed(lambda: silver.upsert(spark, layout, second)),
        "write_gold_refresh": timed(lambda: gold.refresh(spark, layout, second)),
        "write_export_incremental": timed(lambda: run_export(spark, layout)),
        "write_ingest_frames": timed(lambda: ingest_frames(frames, common.new_layout(spark, "bench"), "bench")),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("tradelake-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    configure(spark)
    registered = queries()
    rows = {"events": common.events(spark, folder).count(), "lineitem": tape.table(spark, folder, "lineitem").count()}
    common.whole_tape(spark, folder)
    common.two_deliveries(spark, folder)

    seconds: dict[str, float] = {}
    for name in READS + STREAMS:
        drain = lambda: registered[name](spark, folder).write.format("noop").mode("overwrite").save()  # noqa: B023, E731
        drain()
        seconds[name] = statistics.median(timed(drain) for _ in range(1 if name in STREAMS else runs))
    frames = landed_frames(spark, folder)
    for name, flow in {"landed_flatten": flatten(frames), "landed_validate": validate(flatten(frames))}.items():
        drain = lambda: flow.write.format("noop").mode("overwrite").save()  # noqa: B023, E731
        drain()
        seconds[name] = statistics.median(timed(drain) for _ in range(runs))
    passes = [layered_run(spark, folder, frames) for _ in range(2)]
    seconds.update({name: min(p[name] for p in passes) for name in passes[0]})
    spark.stop()

    rate = {n: round((rows["lineitem"] if n in LINE_QUERIES else rows["events"]) / s) for n, s in seconds.items()}
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {n: round(s, 4) for n, s in seconds.items()},
        "sf": folder.rsplit("sf", 1)[-1],
        "input_rows": rows,
        "input_rows_per_sec": rate,
    }))


if __name__ == "__main__":
    main()
