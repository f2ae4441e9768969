"""Checks, the gate, rolling metrics and the shape of the plans."""

import random
from datetime import UTC, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import at
from pyspark.sql import functions as F
from test_silver_gold import deliver
from trades import payload, payloads, sorted_rows

from tradelake.functions.ranges import outside
from tradelake.functions.windows import after_bookmark, between_windows, bookmark_max
from tradelake.operators import quality
from tradelake.operators.absent import BROADCAST_BYTES, absent_rows, id_bytes
from tradelake.operators.metrics import all_metrics, vwap
from tradelake.operators.rolling import rolling_vwap
from tradelake.plans import bronze, dashboards, export, gold, refresh, silver
from tradelake.schemas import VWAP_TABLE
from tradelake.sources.tables import on_days, read_bronze, read_gold, read_silver
from tradelake.streaming.options import LATENESS


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_failing_rows(spark):
    df = spark.sql("select * from values ('a', 1.0D, 'buy'), ('a', null, 'hold'), (null, -1.0D, null), (null, 2.0D, 'sell') t(k, v, side)")
    assert quality.run("not_null", df, column="v").count() == 1
    assert sorted_rows(quality.run("unique", df, column="k")) == [("a", 2)]
    assert quality.run("accepted_values", df, column="side", values=["buy", "sell"]).count() == 1
    assert quality.run("between", df, column="v", low=0.0, high=5.0).count() == 1
    quality.register("positive", lambda rows, column: rows.filter(F.col(column) <= 0))
    counts = {(r.check, r.column): (r.failures, r.status) for r in quality.report(df, [
        quality.Check("positive", "v", {"column": "v"}), quality.Check("not_null", "k", {"column": "k"}), quality.Check("unique", "k", {"column": "k"}),
    ], "t").collect()}
    assert counts == {("positive", "v"): (1, "fail"), ("not_null", "k"): (2, "fail"), ("unique", "k"): (1, "fail")}
    quality.CHECKS.pop("positive")


def test_vwap_bounds_need_exact_ratios(spark):
    rng = random.Random(3)
    rows = [(str(i), Decimal(rng.randrange(1, 10**9)) / 10**4, Decimal(rng.randrange(1, 10**9)) / 10**8, at(1, 0, 0) + timedelta(minutes=i)) for i in range(500)]
    windows = vwap(spark.createDataFrame(rows, "trade_id string, price decimal(18,8), size decimal(18,8), traded_at timestamp"))
    assert quality.run("vwap_bounds", windows, vwap="vwap_exact", high="high_price", low="low_price").count() == 0
    shifted = windows.withColumn("high_price", F.col("high_price") - F.lit("0.00000001").cast("decimal(18,8)"))
    assert quality.run("vwap_bounds", shifted, vwap="vwap_exact", high="high_price", low="low_price").count() == 500
    assert quality.run("vwap_bounds", windows.withColumn("vwap_exact", F.lit(None).cast("decimal(38,8)")), vwap="vwap_exact", high="high_price", low="low_price").count() == 0


@pytest.mark.parametrize(("minutes", "status"), [(5, "pass"), (30, "pass"), (31, "warn"), (120, "warn"), (121, "error")])
def test_freshness(spark, minutes, status):
    df = spark.sql("select timestamp'2026-04-10 10:00:00' ts")
    assert quality.freshness(df, "ts", at(10, 10) + timedelta(minutes=minutes)).first().status == status


def test_freshness_of_nothing_is_an_error(spark):
    df = spark.sql("select timestamp'2026-04-10 10:00:00' ts").limit(0)
    assert quality.freshness(df, "ts", at(10)).first().status == "error"


def test_gate_blocks_and_reopens(spark, layout):
    def run(texts, when):
        bronze.append(spark, layout, payloads(spark, texts), when, keep="all")
        return refresh.refresh(spark, layout, when)

    good = run([payload("a", time=at(9)), payload("b", time=at(10))], at(20))
    assert good.published and [r.rows_written for r in good.exports] == [2, 2]
    bad = run([payload("c", size=0, time=at(11))], at(21))
    assert not bad.published and not bad.exports
    assert {(c["table"], c["check"], c["column"]) for c in bad.failed_checks} == {(VWAP_TABLE, "not_null", "vwap")}
    assert export.row_count(spark, layout, VWAP_TABLE) == 2
    # an unrelated arrival must not hide the still failing day
    assert not run([payload("d", time=at(12))], at(22)).published
    mended = run([payload("c", size=1, time=at(11))], at(23))
    assert mended.published and export.row_count(spark, layout, VWAP_TABLE) == 4
    with pytest.raises(ValueError, match="timezone-aware"):
        refresh.refresh(spark, layout, datetime(2026, 4, 1))


@pytest.mark.parametrize("seconds", [3600, 86_400, 200_000])
def test_rolling_vwap_against_brute_force(spark, seconds):
    rng = random.Random(seconds)
    rows = [(rng.choice("AAB"), at(1) + timedelta(minutes=30 * i), Decimal(rng.randrange(1, 999)), Decimal(rng.randrange(0, 3))) for i in rng.sample(range(400), 150)]
    windows = spark.createDataFrame([(p, t, None, q * s, s) for p, t, q, s in rows], "product_id string, window_start timestamp, vwap double, notional decimal(38,16), total_volume decimal(28,8)")
    got = {(r.product_id, r.window_start.replace(tzinfo=UTC)): r.rolling_vwap for r in rolling_vwap(windows, seconds, ["product_id"]).collect()}
    assert len(got) == len(rows)
    for product, moment, _, _ in rows:
        seen = [(q * s, s) for p, t, q, s in rows if p == product and timedelta(0) <= moment - t <= timedelta(seconds=seconds)]
        volume = sum(s for _, s in seen)
        assert got[product, moment] == (pytest.approx(float(sum(n for n, _ in seen) / volume)) if volume else None)


def test_window_bounds_equal_filtering_window_starts(spark):
    df = spark.range(200).select((F.lit(at(10)).cast("timestamp") + F.make_interval(secs=F.col("id") * 17)).alias("ts"))
    for since, until in [(at(10, 0, 3), at(10, 0, 20)), (at(10, 0, 3, 30), at(10, 0, 20, 1)), (None, at(10, 0, 5)), (at(10, 0, 50), None)]:
        start = F.date_trunc("minute", "ts")
        want = df.filter((start >= F.lit(since)) if since else F.lit(True)).filter((start < F.lit(until)) if until else F.lit(True))
        assert sorted_rows(between_windows(df, "ts", since, until)) == sorted_rows(want)


def test_bookmark(spark):
    df = spark.sql("select explode(array(timestamp'2026-04-10 10:00:00', timestamp'2026-04-10 11:00:00')) ts")
    assert bookmark_max(df.limit(0), "ts").first().bookmark.year == 1900
    mark = bookmark_max(df.filter("hour(ts) = 10"), "ts")
    assert after_bookmark(df, "ts", mark).count() == 1 and after_bookmark(df, "ts", mark, inclusive=True).count() == 2
    assert LATENESS == "30 minutes"


def test_plans(spark, layout):
    deliver(spark, layout, [payload("a", time=at(9)), payload("b", time=at(10))], at(20))
    export.run_export(spark, layout)
    # a hot id is limited inside each task before the exchange
    arrivals = read_bronze(spark, layout.bronze)
    text = plan(silver.latest_trades(silver.parse(bronze.batches(spark, layout).filter(outside("batch", [(1, 1), (3, 90)])))))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial") and text.count("Exchange") == 1
    assert "batch" in text.split("PartitionFilters: [")[1].split("]")[0] and "PushedFilters: [IsNotNull(trade_id)]" in text
    # one exchange feeds both gold tables, after a map-side step
    text = plan(all_metrics(read_silver(spark, layout.silver)))
    assert text.count("Exchange") == 1 and "partial_sum" in text and "ReadSchema: struct<price:decimal(18,8),size:decimal(18,8),side:string,traded_at:timestamp>" in text
    # readers prune days and row groups
    text = plan(read_gold(spark, layout.lake(VWAP_TABLE), VWAP_TABLE, since=at(10)).select("window_start", "vwap"))
    assert "PartitionFilters: [(struct(year" in text and "GreaterThan(window_start" in text and "ReadSchema: struct<window_start:timestamp,vwap:double>" in text
    text = plan(read_silver(spark, layout.silver, since=at(10), until=at(11)).select("price"))
    assert "trade_date" in text.split("PartitionFilters: [")[1].split("]")[0] and "GreaterThanOrEqual(traded_at" in text
    text = plan(on_days(read_silver(spark, layout.silver), "trade_date", [at(10).date()]).select("price"))
    assert "trade_date" in text.split("PartitionFilters: [")[1].split("]")[0]
    # the newest windows are a top-k, not a sort
    text = plan(dashboards.latest(spark, layout, "vwap", 1))
    assert "TakeOrderedAndProject" in text
    # charts open the pieces that the manifest names for them
    assert len(dashboards.latest(spark, layout, "vwap", 1).inputFiles()) == 1
    assert len(dashboards.latest(spark, layout, "vwap", 2).inputFiles()) == 2
    assert len(dashboards.recent(spark, layout, "vwap", as_of=at(10, 1), minutes=90).inputFiles()) == 1
    assert len(read_silver(spark, layout.silver, since=at(10), until=at(10, 5)).inputFiles()) == 1
    text = plan(read_gold(spark, layout.lake(VWAP_TABLE), VWAP_TABLE, until=at(11)))
    assert "<= [2026,04,11]" in text.split("PartitionFilters: [")[1] and "LessThan(window_start" in text
    # batch ids are broadcast by measured size only; beyond the bound they are shuffled
    batch = arrivals.select("payload", "trade_id", "received_at")
    assert batch.agg(id_bytes()).first()[0] == 2 * 65 and batch.limit(0).agg(id_bytes()).first()[0] == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for size, joined in [(130, "BroadcastHashJoin"), (BROADCAST_BYTES + 1, "SortMergeJoin"), (None, "SortMergeJoin")]:
            rows = absent_rows(batch, read_bronze(spark, layout.bronze), measured_bytes=size)
            semi = next(line for line in plan(rows).splitlines() if "LeftSemi" in line)
            assert joined in semi and rows.count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert gold.TABLES[0] == VWAP_TABLE
