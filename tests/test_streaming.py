"""Streams: parity with batch, replay, poison records, late data."""

import random
import time
from decimal import Decimal

import pyarrow as pa
import pytest
from conftest import at
from trades import VALID, changed, frame, payload, payloads, sorted_rows

from tradelake.operators.metrics import vwap
from tradelake.plans import bronze, gold, silver
from tradelake.schemas import VWAP_TABLE
from tradelake.sources.feed import stream_frames
from tradelake.sources.tables import read_bronze, read_quarantine, read_silver
from tradelake.streaming.ingest import ingest_frames, start_ingest
from tradelake.streaming.late import LateRows, dropped, repair
from tradelake.streaming.options import broker_options, trigger
from tradelake.streaming.windows import _thinned, dedup_stream, start_vwap, vwap_windows

TRADES = "trade_id string, price decimal(18,8), size decimal(18,8), side string, traded_at timestamp"
COLUMNS = ["window_start", "vwap", "vwap_exact", "total_volume", "trade_count", "high_price", "low_price"]


def write_files(spark, folder, batches):
    """One parquet file per batch, in order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, TRADES).coalesce(1).write.parquet(f"{folder}/{i:03d}")


def stream(spark, folder):
    return spark.readStream.schema(TRADES).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def random_trades(seed, count, first_id=0):
    rng = random.Random(seed)
    return [(f"t{first_id + i}", Decimal(rng.randrange(100, 999)) / 10, Decimal(rng.randrange(1, 50)) / 10, rng.choice(["buy", "sell"]), at(10, 9, rng.randrange(20), rng.randrange(60))) for i in range(count)]


def test_windows_over_many_micro_batches_equal_batch(spark, layout, tmp_path):
    batches = [random_trades(s, 30, 100 * s) for s in range(4)]
    write_files(spark, tmp_path / "in", batches)
    query = start_vwap(vwap_windows(stream(spark, tmp_path / "in")), layout, str(tmp_path / "cp"), available_now=True)
    query.awaitTermination()
    assert len(query.recentProgress) >= 4
    everything = spark.read.schema(TRADES).parquet(str(tmp_path / "in" / "*"))
    assert sorted_rows(gold.read(spark, layout, VWAP_TABLE), *COLUMNS) == sorted_rows(vwap(everything), *COLUMNS)


def test_dedup_across_batches_with_a_hot_id(spark, tmp_path):
    base = random_trades(1, 20)
    hot = [base[0]] * 30
    write_files(spark, tmp_path / "in", [base, base[5:15] + hot, hot + random_trades(2, 5, 50)])
    out = str(tmp_path / "out")
    rows = dedup_stream(stream(spark, tmp_path / "in"))
    query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    state = [p.stateOperators for p in query.recentProgress if p.stateOperators]
    assert all(len(operators) == 1 for operators in state)  # one state, on disk
    assert "rocksdbCommitFlushLatency" in state[0][0].customMetrics
    assert max(p.numInputRows for p in query.recentProgress) == 40
    got = [r.trade_id for r in spark.read.parquet(out).collect()]
    assert sorted(got) == sorted({f"t{i}" for i in [*range(20), *range(50, 55)]})


def test_repeats_that_arrive_together_are_dropped_before_the_state():
    batch = pa.RecordBatch.from_pydict({"trade_id": ["b", None, "a", "b", "a", None, "c"], "n": list(range(7))})
    assert [b.column("n").to_pylist() for b in _thinned([batch])] == [[0, 1, 2, 6]]
    assert [b.num_rows for b in _thinned([batch.slice(0, 0), batch.slice(2, 2)])] == [0, 2]


def test_late_trades_are_told_and_put_back(spark, layout, tmp_path):
    in_time = [("t1", Decimal(10), Decimal(1), "buy", at(10, 9, 0)), ("t2", Decimal(20), Decimal(1), "buy", at(10, 12, 0))]
    late = [("t3", Decimal(30), Decimal(2), "sell", at(10, 9, 0)), ("t4", Decimal(40), Decimal(1), "sell", at(10, 12, 0))]
    # a batch drops what lies behind the watermark that the batch before it began with
    write_files(spark, tmp_path / "in", [in_time, in_time[1:], late])
    listener = LateRows()
    spark.streams.addListener(listener)
    try:
        query = start_vwap(vwap_windows(stream(spark, tmp_path / "in")), layout, str(tmp_path / "cp"), available_now=True)
        query.awaitTermination()
        for _ in range(100):
            if listener.rows[query.id]:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert dropped(query) == 1 == listener.rows[query.id]
    counts = lambda: {r.window_start.hour: (r.trade_count, r.vwap) for r in gold.read(spark, layout, VWAP_TABLE).collect()}
    assert counts() == {9: (1, 10.0), 12: (3, pytest.approx(80 / 3))}
    texts = [payload(i, p, s, side, moment) for i, p, s, side, moment in in_time + late]
    bronze.append(spark, layout, payloads(spark, texts), at(11))
    repair(spark, layout, at(11))
    want = {9: (2, pytest.approx(70 / 3)), 12: (2, 30.0)}
    assert counts() == want
    # the stream goes on and is late again; its days are taken back although silver did not change
    write_files(spark, tmp_path / "more" / "in", [in_time[:1]])
    start_vwap(vwap_windows(stream(spark, tmp_path / "more" / "in")), layout, str(tmp_path / "cp2"), available_now=True).awaitTermination()
    assert counts()[9] == (1, 10.0)
    assert repair(spark, layout, at(11)) == [at(10).date()] and counts() == want
    assert repair(spark, layout, at(11)) == []


def land(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_ingest_isolates_poison_and_survives_restart(spark, layout, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "1.txt", [frame(changed(trade_id="a"), changed(trade_id="b", side="hold")), "garbage", frame(changed(trade_id="c"), 5)])
    source = stream_frames(spark, str(landing), max_files_per_trigger=1)
    reports = []
    run = lambda: start_ingest(source, layout, str(tmp_path / "cp"), available_now=True, on_batch=reports.append).awaitTermination()
    run()
    land(landing, "2.txt", [frame(changed(trade_id="c"), changed(trade_id="d", side="SELL"))])
    run()
    assert sorted(r.trade_id for r in read_bronze(spark, layout.bronze).collect()) == ["a", "c", "d"]
    assert [(r.received, r.valid, r.invalid, r.inserted, r.duplicates) for r in reports] == [(4, 2, 2, 2, 0), (2, 2, 0, 1, 1)]
    reasons = sorted(r.reasons[0] for r in read_quarantine(spark, layout.quarantine).collect())
    assert reasons == ["frame_not_json", "side_unknown", "trade_not_object"]
    silver.upsert(spark, layout, at(30))
    assert {r.trade_id: r.side for r in read_silver(spark, layout.silver).collect()} == {"a": VALID["side"], "c": VALID["side"], "d": "sell"}


def test_replayed_batch_changes_nothing(spark, layout):
    lines = spark.createDataFrame([(frame(changed(trade_id="a"), changed(trade_id="b", price="0")),), ("junk",)], "raw string")
    first = ingest_frames(lines, layout, "ingest-000000000007")
    again = ingest_frames(lines, layout, "ingest-000000000007")
    assert (first.inserted, again.inserted, again.duplicates) == (1, 0, 1)
    assert read_bronze(spark, layout.bronze).count() == 1 and read_quarantine(spark, layout.quarantine).count() == 2


def test_product_subscription(spark, layout):
    lines = spark.createDataFrame([(frame(changed(trade_id="a", product_id="BTC-USD"), changed(trade_id="b", product_id="ETH-USD")),)], "raw string")
    assert ingest_frames(lines, layout, "x", products=["ETH-USD"]).inserted == 1
    assert payload("b") and read_bronze(spark, layout.bronze).first().trade_id == "b"


def test_product_subscription_counts_and_sets_aside_every_record(spark, layout):
    trades = [
        changed(trade_id="a", product_id="BTC-USD"), changed(trade_id="b", product_id="ETH-USD"),
        changed(trade_id="c"), changed(trade_id="d", product_id=5), changed(trade_id="e", product_id=""),
        changed(trade_id="f", product_id="BTC-USD", side="hold"), changed(trade_id="g", product_id="ETH-USD", price="0"), 5,
    ]
    report = ingest_frames(spark.createDataFrame([(frame(*trades),)], "raw string"), layout, "x", products=["BTC-USD"])
    assert (report.received, report.valid, report.invalid, report.inserted, report.filtered) == (8, 2, 6, 1, 1)
    assert [r.trade_id for r in read_bronze(spark, layout.bronze).collect()] == ["a"]
    reasons = sorted(r.reasons[0] for r in read_quarantine(spark, layout.quarantine).collect())
    assert reasons == [
        "price_not_positive", "product_id_empty", "product_id_missing", "product_id_not_text", "side_unknown", "trade_not_object"]


def test_pace_options():
    assert trigger() == {"processingTime": "2 seconds"} and trigger(available_now=True) == {"availableNow": True}
    assert broker_options() == {"minOffsetsPerTrigger": "200", "maxTriggerDelay": "2s"}
    assert broker_options(ceiling=10)["maxOffsetsPerTrigger"] == "10"
