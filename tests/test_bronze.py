"""Idempotent ingest."""

import pytest
from conftest import at
from pyspark.sql import functions as F
from trades import payload, payloads, sorted_rows

from tradelake.plans import bronze, ledger, silver
from tradelake.sources.tables import read_bronze


def stored(spark, layout):
    return sorted_rows(read_bronze(spark, layout.bronze), "trade_id", "received_at")


def test_repeating_a_batch_adds_nothing(spark, layout):
    batch = payloads(spark, [payload("a"), payload("b"), payload("c")])
    first = bronze.append(spark, layout, batch, at(10))
    before = stored(spark, layout)
    again = bronze.append(spark, layout, batch, at(11))
    assert (first.attempted, first.inserted, first.duplicates) == (3, 3, 0)
    assert (again.attempted, again.inserted, again.duplicates) == (3, 0, 3)
    assert stored(spark, layout) == before and len(before) == 3


def test_first_arrival_wins_within_a_batch(spark, layout):
    batch = payloads(spark, [payload("a", price=2), payload("a", price=1), payload("b")])
    assert bronze.append(spark, layout, batch, at(10)).inserted == 2


def test_null_ids_never_conflict(spark, layout):
    batch = payloads(spark, ['{"price":"1"}', '{"price":"1"}', payload("a")])
    bronze.append(spark, layout, batch, at(10))
    report = bronze.append(spark, layout, batch, at(11))
    assert report.inserted == 2
    assert [r[0] for r in stored(spark, layout)].count(None) == 4


def test_empty_batch_and_single_row(spark, layout):
    empty = payloads(spark, [payload("a")]).limit(0)
    assert bronze.append(spark, layout, empty, at(10)).inserted == 0
    assert bronze.append(spark, layout, payloads(spark, [payload("a")]), at(10)).inserted == 1


def test_payload_is_stored_as_received(spark, layout):
    text = payload("a", price="100.10")
    bronze.append(spark, layout, payloads(spark, [text]), at(10))
    row = read_bronze(spark, layout.bronze).first()
    assert row.payload == text and row.trade_id == "a"


def test_ids_are_known_before_and_after_silver_has_taken_them(spark, layout, monkeypatch):
    for literals in (10_000, 0):  # looked up as literals, and by a join
        monkeypatch.setattr(ledger, "LITERAL_IDS", literals)
        old, new, broken = f"old{literals}", f"new{literals}", f"broken{literals}"
        bronze.append(spark, layout, payloads(spark, [payload(old), payload(broken, price="abc")]), at(1))
        silver.upsert(spark, layout, at(2), mode="quarantine")
        bronze.append(spark, layout, payloads(spark, [payload(new)]), at(9))
        batch = payloads(spark, [payload(old), payload(new), payload(broken), payload(f"x{literals}")])
        assert bronze.append(spark, layout, batch, at(10)).inserted == 1
        assert bronze.append(spark, layout, batch, at(11)).inserted == 0


def test_a_batch_reads_only_matching_row_groups_of_its_buckets(spark, layout, monkeypatch):
    monkeypatch.setitem(ledger.BLOOM, "parquet.block.size", str(64 << 10))
    ids = spark.range(60_000).select(F.to_json(F.struct(F.concat(F.lit("t"), F.col("id").cast("string")).alias("trade_id"), F.lit("1").alias("price"))).alias("payload"))
    bronze.append(spark, layout, ids, at(10))
    silver.upsert(spark, layout, at(11))
    few = bronze.stamp(payloads(spark, [payload("new-a"), payload("new-b"), payload("new-c")]), at(12))
    found = ledger.looked_up(spark, layout, few, 3, 300)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(trade_id" in plan and "Join" not in plan
    assert len(found.inputFiles()) <= 3 < ledger.BUCKETS
    assert found.collect() == [] and rows_scanned(found) == 0
    one = ledger.looked_up(spark, layout, bronze.stamp(payloads(spark, [payload("t777")]), at(12)), 1, 100)
    assert [r.trade_id for r in one.collect()] == ["t777"] and rows_scanned(one) < 60_000 / ledger.BUCKETS


def rows_scanned(df):
    """Rows that the scans of a collected frame handed on."""
    def walk(node):
        own = [node.metrics().apply("numOutputRows").value()] if node.nodeName().startswith("Scan") else []
        kids = node.children().iterator()
        while kids.hasNext():
            own += walk(kids.next())
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            own += walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            own += walk(node.plan())
        return own
    return sum(walk(df._jdf.queryExecution().executedPlan()))


def test_hot_id_is_thinned_before_the_exchange(spark, layout):
    ids = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("i"))
    batch = ids.select(F.to_json(F.struct(F.col("i").alias("trade_id"))).alias("payload"))
    report = bronze.append(spark, layout, batch, at(10))
    assert (report.attempted, report.inserted) == (30_000, 20_001)


def test_arrival_stamp_needs_a_zone(spark, layout):
    with pytest.raises(ValueError, match="timezone-aware"):
        bronze.append(spark, layout, payloads(spark, [payload("a")]), at(10).replace(tzinfo=None))
    with pytest.raises(ValueError, match="policy"):
        bronze.append(spark, layout, payloads(spark, [payload("a")]), at(10), keep="some")


@pytest.mark.parametrize("keep", ["first", "all"])
def test_the_messages_of_a_batch_are_made_once(spark, layout, keep):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    batch = payloads(spark, [payload("a"), payload("b"), payload("b")]).select("payload").mapInArrow(counted, "payload string")
    report = bronze.append(spark, layout, batch, at(10), keep=keep)
    assert made.value == 3 and report.inserted == (2 if keep == "first" else 3)
