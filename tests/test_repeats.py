"""Rows of ids that come once take a way of their own; large batches end as small ones do."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import functions as F

from tradelake.operators.validate import validate
from tradelake.plans import bronze, ledger, repeats, silver
from tradelake.queries import streams
from tradelake.schemas import Layout
from tradelake.session import scratch_path
from tradelake.sources.feed import is_document, parse_frames
from tradelake.sources.tables import read_bronze, read_silver

AT = datetime(2024, 1, 1, tzinfo=UTC)


def messages(spark, prices):
    rows = [
        (json.dumps({"trade_id": i, "price": p, "size": "1", "side": "buy", "time": "2024-01-01T00:00:00Z", "product_id": "A"}), i)
        for i, p in prices]
    return spark.createDataFrame(rows, "payload string, trade_id string")


def test_ids_that_come_again_are_told_apart(spark):
    rows = messages(spark, [("a", "1"), ("b", "2"), ("a", "3"), (None, "4"), (None, "5")])
    with repeats.once_and_again(rows) as (once, again):
        assert sorted(r.trade_id or "" for r in once.collect()) == ["", "", "b"]
        assert [r.trade_id for r in again.collect()] == ["a", "a"]
    with repeats.once_and_again(rows.filter("trade_id = 'b'")) as (once, again):
        assert again is None and once.count() == 1


def test_too_many_repeats_count_as_all(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", 0)
    with repeats.once_and_again(messages(spark, [("a", "1"), ("a", "2"), ("b", "3")])) as (once, again):
        assert once is None and again.count() == 3


def test_large_first_batch_keeps_the_first_and_silver_the_latest(spark, monkeypatch):
    monkeypatch.setattr(ledger, "LITERAL_IDS", 0)
    layout = Layout(scratch_path(spark, "repeats"))
    report = bronze.append(spark, layout, messages(spark, [("a", "1"), ("b", "2"), ("a", "3"), (None, "4")]), AT)
    assert (report.attempted, report.inserted) == (4, 3)
    assert sorted(r.trade_id or "" for r in read_bronze(spark, layout.bronze).collect()) == ["", "a", "b"]
    assert silver.upsert(spark, layout, AT).inserted_or_changed == 2
    bronze.append(spark, layout, messages(spark, [("b", "7"), ("c", "8"), ("c", "9")]), datetime(2024, 1, 2, tzinfo=UTC), keep="all")
    silver.upsert(spark, layout, AT)
    found = {r.trade_id: float(r.price) for r in read_silver(spark, layout.silver).collect()}
    assert found == {"a": 1.0, "b": 7.0, "c": 9.0}


def test_ids_that_come_once_are_not_sorted(spark):
    rows = bronze.stamp(messages(spark, [(str(i), "1") for i in range(20)]), AT)
    with silver._latest_typed(rows, "strict", None) as table:
        assert "Window" not in table._jdf.queryExecution().optimizedPlan().toString()


def test_objects_are_told_without_their_schema(spark):
    raw = ['{"a": [1, {"b": 2}]}', "{}", "[1]", '"{"', "1", "null", "{", None]
    parsed = parse_frames(spark.createDataFrame([(x,) for x in raw], "raw string")).select("*", is_document().alias("is"))
    assert [r["is"] for r in parsed.select("is").collect()] == [True, True, False, False, False, False, False, False]
    assert "schema_of_variant" not in str(is_document())
    trades = spark.createDataFrame([('{"trade_id": null, "price": 1.5, "other": {"x": 1}}',), ("[1]",)], "raw string")
    checked = validate(trades.select(F.parse_json("raw").alias("trade"))).select("reasons").collect()
    assert checked[0].reasons == "trade_id_missing,price_is_float,size_missing,side_missing,time_missing"
    assert checked[1].reasons == "trade_not_object"


def test_late_parts_are_landed_by_all_tasks(spark, tmp_path, monkeypatch):
    rows = spark.range(400).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id * 10 AS int)) AS ts", "id AS user_id",
        "'view' AS event_type", "1.5D AS value", "'{\"k\": 5}' AS props")
    rows.repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    made, path_of = {}, streams.scratch_path
    monkeypatch.setattr(streams, "scratch_path", lambda spark, label: made.setdefault(label, path_of(spark, label)))
    monkeypatch.setattr(streams, "comparable", lambda df: df)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        out = streams._late(spark, str(tmp_path))
        assert out.agg(F.sum("trade_count")).first()[0] == 400 and {r.late_told for r in out.collect()} == {True}
        assert len(spark.read.parquet(f"{made['late-landing']}/2").inputFiles()) > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
