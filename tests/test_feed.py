"""Frames: parsing, channel filter, flattening."""

import json

from pyspark.sql import functions as F
from trades import VALID, changed, frame, payload

from tradelake.operators.flatten import flatten, of_products
from tradelake.sources.feed import bad_frames, parse_frames, read_frames
from tradelake.sources.wire import to_wire


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "raw string")


def ids(df):
    return sorted(r[0] for r in df.select(F.try_variant_get("trade", "$.trade_id", "string")).collect())


def test_only_market_trades_are_kept(spark):
    df = lines(spark, frame(VALID), frame(changed(trade_id="x"), channel="heartbeats"), json.dumps({"type": "subscriptions"}))
    assert ids(flatten(df)) == ["t-7001"]


def test_every_event_and_trade(spark):
    doc = {"channel": "market_trades", "events": [{"trades": [changed(trade_id="a"), changed(trade_id="b")]}, {"trades": []}, {}, {"trades": [changed(trade_id="c")]}]}
    assert ids(flatten(lines(spark, json.dumps(doc)))) == ["a", "b", "c"]


def test_missing_null_or_misshapen_lists_are_empty(spark):
    texts = ['{"channel":"market_trades"}', '{"channel":"market_trades","events":null}', '{"channel":"market_trades","events":{"a":1}}', '{"channel":"market_trades","events":[4,{"trades":null}]}']
    assert flatten(lines(spark, *texts)).count() == 0
    assert bad_frames(parse_frames(lines(spark, *texts))).count() == 0


def test_bad_frames_are_kept_whole(spark):
    rows = bad_frames(parse_frames(lines(spark, "not json " + "x" * 500, "[1,2]", frame(VALID)))).collect()
    assert sorted((r.reasons[0], len(r.raw)) for r in rows) == [("frame_not_json", 509), ("frame_not_object", 5)]


def test_repeated_member_keeps_the_last(spark):
    text = '{"channel":"heartbeats","channel":"market_trades","events":[{"trades":[{"trade_id":"a"}]}]}'
    assert ids(flatten(lines(spark, text))) == ["a"]


def test_product_filter(spark):
    df = flatten(lines(spark, frame(changed(trade_id="a", product_id="BTC-USD"), changed(trade_id="b", product_id="ETH-USD"), changed(trade_id="c"))))
    assert ids(of_products(df, ["BTC-USD"])) == ["a"]


def test_text_source(spark, tmp_path):
    (tmp_path / "f.txt").write_text(frame(VALID) + "\n")
    assert ids(flatten(read_frames(spark, str(tmp_path)))) == ["t-7001"]


def test_wire_message_is_a_flat_object_of_texts(spark):
    df = spark.sql("select 'a' trade_id, 'P' product_id, cast(1.5 as decimal(18,8)) price, cast(2 as decimal(18,8)) size, 'buy' side, timestamp'2026-04-10 10:00:00' traded_at")
    assert json.loads(to_wire(df).first().payload) == {"trade_id": "a", "price": "1.50000000", "size": "2.00000000", "side": "buy", "time": "2026-04-10T10:00:00.000000Z", "product_id": "P"}
    assert json.loads(payload("a"))["trade_id"] == "a"
