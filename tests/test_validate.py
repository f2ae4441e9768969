"""Validation rules: one valid record, one member changed per case."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from trades import VALID, changed

from tradelake.operators.validate import accepted, health_counts, reason_counts, rejected, validate


def check(spark, *records):
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    raw = spark.createDataFrame([(t,) for t in texts], "raw string")
    return validate(raw.select(F.parse_json("raw").alias("trade")))


def reasons(spark, record):
    return check(spark, record).first().reasons


def test_valid_record_is_typed(spark):
    row = accepted(check(spark, VALID)).first()
    assert (row.trade_id, row.price, row.size, row.side) == ("t-7001", Decimal("1250.5"), Decimal("3.25"), "sell")
    assert row.traded_at == datetime(2026, 5, 2, 8, 31, 7)


@pytest.mark.parametrize("text", ["2026-05-02T08:31:07z", "2026-05-02 08:31:07.000Z", "2026-05-02T10:31:07+0200"])
def test_zoned_times_are_read(spark, text):
    assert accepted(check(spark, changed(time=text))).first().traded_at == datetime(2026, 5, 2, 8, 31, 7)


@pytest.mark.parametrize("text", ["2026-05-02T08:31Z", "2026-05-02T08:31z", "2026-05-02T10:31+02:00"])
def test_times_without_seconds_are_read(spark, text):
    assert accepted(check(spark, changed(time=text))).first().traded_at == datetime(2026, 5, 2, 8, 31)


@pytest.mark.parametrize("side", ["BUY", "SELL", "Sell"])
def test_side_is_lowered(spark, side):
    assert accepted(check(spark, changed(side=side))).first().side == side.lower()


@pytest.mark.parametrize(
    ("members", "reason"),
    [
        ({"side": "bid"}, "side_unknown"),
        ({"side": 1}, "side_not_text"),
        ({"side": None}, "side_missing"),
        ({"price": 1250.5}, "price_is_float"),
        ({"price": 1e30}, "price_is_float"),
        ({"price": "0.00"}, "price_not_positive"),
        ({"price": "-1"}, "price_not_positive"),
        ({"price": "-99999999999999"}, "price_not_positive"),
        ({"price": "ten"}, "price_not_decimal"),
        ({"price": "NaN"}, "price_not_decimal"),
        ({"price": True}, "price_not_decimal"),
        ({"price": None}, "price_missing"),
        ({"price": "12345678901"}, "price_out_of_range"),
        ({"size": "-0.5"}, "size_not_positive"),
        ({"size": "0.000000001"}, "size_out_of_range"),
        ({"size": 0.5}, "size_is_float"),
        ({"trade_id": ""}, "trade_id_empty"),
        ({"trade_id": 7}, "trade_id_not_text"),
        ({"trade_id": None}, "trade_id_missing"),
        ({"time": "2026-05-02T08:31:07"}, "time_without_zone"),
        ({"time": "noon"}, "time_not_parseable"),
        ({"time": "2026-13-40T08:31:07Z"}, "time_not_parseable"),
        ({"time": True}, "time_not_parseable"),
        ({"time": None}, "time_missing"),
    ],
)
def test_broken_rule_is_named(spark, members, reason):
    assert reasons(spark, changed(**members)) == reason


@pytest.mark.parametrize("members", [{"price": 50000}, {"price": "5e4"}, {"size": " 1.50 "}, {"product_id": "BTC-USD"}])
def test_accepted_forms(spark, members):
    assert reasons(spark, changed(**members)) == ""


@pytest.mark.parametrize(
    ("time", "hour"),
    [("2026-04-23T15:00:00+02:00", 13), ("2026-04-23T15:00:00-0330", 18), ("2026-04-23 15:00:00.123456Z", 15), (1776956400, 15), ("1776956400000", 15)],
)
def test_time_is_converted_to_utc(spark, time, hour):
    assert accepted(check(spark, changed(time=time))).first().traded_at.hour == hour


def test_all_broken_rules_are_listed(spark):
    bad = {"trade_id": "", "price": "-1", "size": "0", "side": "HOLD", "time": "bad"}
    row = rejected(check(spark, bad)).first()
    assert row.reasons == ["trade_id_empty", "price_not_positive", "size_not_positive", "side_unknown", "time_not_parseable"]
    assert json.loads(row.raw) == bad


def test_non_object_is_rejected_without_stopping_the_rest(spark):
    checked = check(spark, VALID, "5", "[1]", "null")
    assert accepted(checked).count() == 1
    assert [r.reasons for r in rejected(checked).collect()] == [["trade_not_object"]] * 3


def test_counts(spark):
    checked = check(spark, VALID, changed(side="hold", price="0"), changed(price="0"))
    assert tuple(health_counts(checked).first()) == (3, 1, 2)
    assert {r.reason: r.records for r in reason_counts(checked).collect()} == {"side_unknown": 1, "price_not_positive": 2}
