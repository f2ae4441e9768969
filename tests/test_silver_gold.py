"""Incremental silver and gold equal a full rebuild, whatever the arrival order."""

import random
from collections import defaultdict
from datetime import timedelta
from decimal import Decimal
from statistics import stdev

import pytest
from conftest import at
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from trades import payload, payloads, sorted_rows

from tradelake.operators.metrics import vwap
from tradelake.plans import bronze, dashboards, gold, refresh, silver
from tradelake.schemas import SILVER, STATS_TABLE, VWAP_TABLE, Layout
from tradelake.sources import snapshots
from tradelake.sources.tables import read_quarantine, read_silver

SILVER_COLUMNS = SILVER.names
VWAP_COLUMNS = ["window_start", "vwap", "vwap_exact", "total_volume", "trade_count", "high_price", "low_price"]
STATS_COLUMNS = ["window_start", "volatility", "buy_count", "sell_count", "buy_volume_pct"]


def deliver(spark, layout, texts, when, **options):
    bronze.append(spark, layout, payloads(spark, texts), when, keep="all")
    report = silver.upsert(spark, layout, when + timedelta(minutes=1), **options)
    gold.refresh(spark, layout, when + timedelta(minutes=1))
    return report


def held_days(spark, root):
    """Days with rows, as the manifest has them."""
    return {key for key, day in snapshots.current(spark, root).days.items() if day.pieces}


def silver_rows(spark, layout):
    return sorted_rows(read_silver(spark, layout.silver), *SILVER_COLUMNS)


def gold_rows(spark, layout):
    vwap = sorted_rows(gold.read(spark, layout, VWAP_TABLE), *VWAP_COLUMNS)
    stats = sorted_rows(gold.read(spark, layout, STATS_TABLE), *STATS_COLUMNS)
    return vwap, [tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in stats]


def rebuilt(spark, layout, tmp_path):
    """Silver and gold built in one go from the same bronze."""
    fresh = Layout(str(tmp_path / "rebuilt"))
    bronze_rows = spark.read.parquet(layout.bronze)
    bronze_rows.write.partitionBy("received_date", "batch").parquet(fresh.bronze)
    silver.rebuild(spark, fresh, at(30))
    gold.rebuild(spark, fresh, at(30))
    return silver_rows(spark, fresh), gold_rows(spark, fresh)


@pytest.mark.parametrize("seed", [1, 2])
def test_shuffled_late_and_corrected_arrivals(spark, layout, tmp_path, seed):
    rng = random.Random(seed)

    def trade(i):
        moment = at(10 + rng.randrange(3), 10, rng.randrange(3), rng.randrange(60))
        return payload(f"t{i}", price=rng.randrange(1, 500), size=rng.randrange(0, 5), side=rng.choice(["buy", "sell"]), time=moment)

    for step in range(3):
        texts = [trade(rng.randrange(25)) for _ in range(18)]
        deliver(spark, layout, texts, at(20, 3 * step))
    want_silver, want_gold = rebuilt(spark, layout, tmp_path)
    assert silver_rows(spark, layout) == want_silver
    assert gold_rows(spark, layout) == want_gold


def test_moved_trade_leaves_its_old_day(spark, layout, tmp_path):
    deliver(spark, layout, [payload("a", time=at(10, 1)), payload("b", time=at(12, 1))], at(20))
    deliver(spark, layout, [payload("a", price=7, time=at(11, 1))], at(21))
    assert held_days(spark, layout.silver) == {"trade_date=2026-04-11", "trade_date=2026-04-12"}
    assert held_days(spark, layout.gold(VWAP_TABLE)) == {"window_date=2026-04-11", "window_date=2026-04-12"}
    want_silver, want_gold = rebuilt(spark, layout, tmp_path)
    assert silver_rows(spark, layout) == want_silver and gold_rows(spark, layout) == want_gold


def test_boundary_trade_joins_the_newest_window(spark, layout):
    deliver(spark, layout, [payload("a", price=10, time=at(10, 1, 5, 30))], at(20))
    deliver(spark, layout, [payload("b", price=20, time=at(10, 1, 5, 0)), payload("c", price=30, time=at(10, 1, 2))], at(21))
    rows = {r.window_start.minute: (r.trade_count, r.vwap) for r in gold.read(spark, layout, VWAP_TABLE).collect()}
    assert rows == {5: (2, 15.0), 2: (1, 30.0)}


def test_equal_stamps_have_one_winner_and_repeats_change_nothing(spark, layout):
    texts = [payload("a", price=1), payload("a", price=3), payload("a", price=2)]
    deliver(spark, layout, texts, at(20))
    before = silver_rows(spark, layout)
    assert [r[2] for r in before] == [Decimal("3.00000000")]
    report = silver.upsert(spark, layout, at(22))
    assert (report.inserted_or_changed, report.days, report.full) == (0, [], False)
    assert silver_rows(spark, layout) == before


def test_arrivals_committed_late_are_picked_up(spark, layout):
    deliver(spark, layout, [payload("a")], at(20, 10))
    bronze.append(spark, layout, payloads(spark, [payload("b")]), at(20, 9, 30))
    silver.upsert(spark, layout, at(20, 12))
    assert [r[0] for r in silver_rows(spark, layout)] == ["a", "b"]


def test_arrivals_committed_days_late_are_picked_up(spark, layout, tmp_path):
    deliver(spark, layout, [payload("a", price=1), payload("c", price=3)], at(20, 10))
    bronze.append(spark, layout, payloads(spark, [payload("b"), payload("c", price=2)]), at(20, 8), keep="all")
    bronze.append(spark, layout, payloads(spark, [payload("d"), payload("a", price=2)]), at(13), keep="all")
    assert silver.upsert(spark, layout, at(20, 12)).inserted_or_changed == 2
    assert {r[0]: int(r[2]) for r in silver_rows(spark, layout)} == {"a": 1, "b": 100, "c": 3, "d": 100}
    assert silver_rows(spark, layout) == rebuilt(spark, layout, tmp_path)[0]
    assert silver.upsert(spark, layout, at(20, 13)).inserted_or_changed == 0


def test_broken_rows_of_one_stamp_in_two_runs_are_all_set_aside(spark, layout):
    for text in ("x", "y"):
        report = deliver(spark, layout, [payload(text, price="abc"), payload(f"good-{text}")], at(20), mode="quarantine")
        assert report.quarantined == 1
    assert len(read_quarantine(spark, layout.quarantine).collect()) == 2


def test_new_days_are_appended_not_rewritten(spark, layout):
    deliver(spark, layout, [payload("a", time=at(10))], at(20))
    files = set(read_silver(spark, layout.silver).inputFiles())
    report = deliver(spark, layout, [payload("b", time=at(10, 1))], at(21))
    assert report.inserted_or_changed == 1
    assert files < set(read_silver(spark, layout.silver).inputFiles())


def test_strict_raises_and_quarantine_sets_aside(spark, layout):
    texts = [payload("a"), payload("b", price="abc"), payload("c", time="yesterday")]
    with pytest.raises(PySparkException):
        deliver(spark, layout, texts, at(20))
    report = silver.upsert(spark, layout, at(21), mode="quarantine")
    assert report.quarantined == 2 and report.full
    assert [r[0] for r in silver_rows(spark, layout)] == ["a"]
    deliver(spark, layout, [payload("d", size="x"), payload("e")], at(22), mode="quarantine")
    assert [r[0] for r in silver_rows(spark, layout)] == ["a", "e"]
    reasons = sorted(r.reasons[0] for r in read_quarantine(spark, layout.quarantine).collect())
    assert reasons == ["price_not_castable", "size_not_castable", "time_not_castable"]
    with pytest.raises(ValueError, match="mode"):
        silver.upsert(spark, layout, at(23), mode="lenient")


def test_metrics_against_plain_arithmetic(spark, layout):
    rng = random.Random(5)
    trades = [(rng.randrange(1, 10**6) / 100, rng.randrange(0, 300) / 100, rng.choice(["buy", "sell"]), rng.randrange(3)) for _ in range(60)]
    deliver(spark, layout, [payload(str(i), p, s, side, at(10, 1, m)) for i, (p, s, side, m) in enumerate(trades)], at(20))
    groups = defaultdict(list)
    for price, size, side, minute in trades:
        groups[minute].append((Decimal(str(price)), Decimal(str(size)), side))
    vwap = {r.window_start.minute: r for r in gold.published(spark, layout, VWAP_TABLE).collect()}
    stats = {r.window_start.minute: r for r in gold.published(spark, layout, STATS_TABLE).collect()}
    for minute, rows in groups.items():
        volume = sum(s for _, s, _ in rows)
        assert vwap[minute].vwap == pytest.approx(float(sum(p * s for p, s, _ in rows) / volume))
        assert vwap[minute].total_volume == float(volume) and vwap[minute].trade_count == len(rows)
        assert (vwap[minute].low_price, vwap[minute].high_price) == (float(min(rows)[0]), float(max(rows)[0]))
        assert stats[minute].volatility == pytest.approx(float(stdev(p for p, _, _ in rows)))
        assert stats[minute].buy_count + stats[minute].sell_count == len(rows)
        assert stats[minute].buy_volume_pct == pytest.approx(float(100 * sum(s for _, s, side in rows if side == "buy") / volume))


def test_single_trade_has_no_volatility_and_no_volume_has_no_vwap(spark, layout):
    deliver(spark, layout, [payload("a", time=at(10, 1)), payload("b", size=0, time=at(10, 2))], at(20))
    assert gold.published(spark, layout, STATS_TABLE).filter("volatility is not null").count() == 0
    row = gold.published(spark, layout, VWAP_TABLE).filter("vwap is null").first()
    assert row.window_start.hour == 2 and row.total_volume == 0.0


def test_new_trades_are_added_to_stored_windows(spark, layout, tmp_path):
    """A late trade reads its own piece and the windows of its day; a correction reads the day."""
    def todo():
        made = [snapshots.current(spark, layout.gold(table)) for table in gold.TABLES]
        return gold.pending(snapshots.current(spark, layout.silver), made)

    rng = random.Random(8)
    trade = lambda i, day, minute: payload(f"t{i}", rng.randrange(1, 10**8) / 1000, rng.randrange(0, 50) / 10, rng.choice(["buy", "sell"]), at(day, 1, minute))
    deliver(spark, layout, [trade(i, 10 + i % 2, i % 3) for i in range(40)], at(20))
    for step in range(3):
        late = [trade(100 + 10 * step + i, 10, i % 4) for i in range(5)]
        bronze.append(spark, layout, payloads(spark, [*late, payload(f"s{step}", 5, 1, time=at(10, 2))]), at(21 + step))
        silver.upsert(spark, layout, at(21 + step))
        before = todo()
        assert before.whole == set() and before.grown == {"trade_date=2026-04-10"}
        read = snapshots.read(spark, layout.silver, SILVER, keep=before.reads)
        assert read.count() == 6 and len(read.inputFiles()) == 1
        assert gold.refresh(spark, layout, at(21 + step)) == [at(10).date()]
        assert silver_rows(spark, layout) and gold_rows(spark, layout) == rebuilt(spark, layout, tmp_path / str(step))[1]
    bronze.append(spark, layout, payloads(spark, [payload("t0", 7)]), at(25), keep="all")
    silver.upsert(spark, layout, at(25))
    assert todo().whole == {"trade_date=2026-04-10"} and not todo().grown


def test_windows_that_a_stream_wrote_are_not_added_to(spark, layout, tmp_path):
    deliver(spark, layout, [payload("a", 10, time=at(10)), payload("b", 20, time=at(11))], at(20))
    ahead = vwap(spark.createDataFrame([(Decimal(10), Decimal(1), at(10)), (Decimal(30), Decimal(1), at(10))], "price decimal(18,8), size decimal(18,8), traded_at timestamp"))
    gold.upsert_windows(ahead.withColumns({"updated_at": F.current_timestamp(), "window_date": F.to_date("window_start")}), layout)
    assert {r.trade_count for r in gold.read(spark, layout, VWAP_TABLE).collect()} == {1, 2}
    deliver(spark, layout, [payload("c", 30, time=at(10)), payload("d", 1, time=at(11))], at(21))
    assert gold_rows(spark, layout) == rebuilt(spark, layout, tmp_path)[1]


def test_trade_without_a_time_is_kept_and_fails_the_check(spark, layout):
    deliver(spark, layout, [payload("a"), '{"trade_id":"b","price":"1","size":"1","side":"buy"}'], at(20))
    assert [(r.trade_id, r.traded_at is None) for r in read_silver(spark, layout.silver).orderBy("trade_id").collect()] == [("a", False), ("b", True)]
    deliver(spark, layout, [payload("b", time=at(10, 3))], at(21))
    assert read_silver(spark, layout.silver).filter("traded_at is null").count() == 0


def test_metrics_keyed_by_product(spark, tmp_path):
    layout = Layout(str(tmp_path / "by"), by=("product_id",))
    a, b = {"product_id": "A"}, {"product_id": "B"}
    deliver(spark, layout, [payload("1", 10, 1, time=at(10), **a), payload("2", 20, 3, time=at(10), **b), payload("3", 30, 1, time=at(10), **b)], at(20))
    deliver(spark, layout, [payload("4", 50, 1, time=at(10), **a)], at(21))
    checks = refresh.refresh(spark, layout, at(22))
    assert checks.published and [r.rows_written for r in checks.exports] == [2, 2]
    assert {r.product_id: (r.vwap, r.trade_count) for r in gold.published(spark, layout, VWAP_TABLE).collect()} == {"A": (30.0, 2), "B": (22.5, 2)}
    assert {(r.product_id, r.vwap) for r in spark.sql("select product_id, vwap from vw_vwap_1min").collect()} == {("A", 30.0), ("B", 22.5)}
    bronze.append(spark, layout, payloads(spark, [payload("5", 5, time=at(11), **a), payload("6", 6, time=at(11), **b)]), at(23))
    refresh.refresh(spark, layout, at(23))
    newest = dashboards.latest(spark, layout, "vwap", 2).collect()
    assert [(r.product_id, r.window_start.day) for r in newest] == [("A", 11), ("B", 11), ("A", 10), ("B", 10)]
    assert dashboards.latest(spark, layout, "pressure").columns == ["product_id", "window_start", "buy_volume_pct", "sell_volume_pct"]
