"""Reading general tables as a trade tape.

Maps an event table and an order-line table onto trade columns, and builds feed
frames from them, so that every operator can be run on those tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.schemas import PRICE

TRADE_COLUMNS = ["trade_id", "product_id", "price", "size", "side", "traded_at"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def event_trades(events: DataFrame) -> DataFrame:
    """events as trades: value is the price, props.k the size."""
    return events.select(
        F.col("event_id").cast("string").alias("trade_id"),
        F.col("event_type").alias("product_id"),
        F.col("value").cast(PRICE).alias("price"),
        F.get_json_object("props", "$.k").cast(PRICE).alias("size"),
        F.when(F.col("event_type").isin("purchase", "signup"), "buy").otherwise("sell").alias("side"),
        F.col("ts").alias("traded_at"),
    )


def line_trades(lineitem: DataFrame) -> DataFrame:
    """order lines as trades; an order line occurs several times."""
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trade_id"),
        F.col("l_returnflag").alias("product_id"),
        F.col("l_extendedprice").cast(PRICE).alias("price"),
        F.col("l_quantity").cast(PRICE).alias("size"),
        F.when(F.col("l_linestatus") == "O", "buy").otherwise("sell").alias("side"),
        F.col("l_shipdate").alias("traded_at"),
    )


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as a stream of its files, whether it is a file or a folder."""
    return spark.readStream.schema(table(spark, folder, name).schema).parquet(f"{folder}/{{{name}.parquet}}")


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def faulty_json(events: DataFrame) -> DataFrame:
    """One JSON trade text per event; the size value picks which rule it breaks.

    0 size zero, 1 empty id, 2 unknown side, 3 price zero, 4 negative size,
    5 no zone, 6 price as JSON fraction, 7 upper-case side (valid), 8 numeric
    side, 9 no price, 10 numeric id, 11 price beyond the silver range; every
    other trade is valid.
    """
    trades = event_trades(events)
    k = F.col("size").cast("int")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    members = [
        F.when(k == 10, F.concat(F.lit('"trade_id":'), "trade_id"))
        .otherwise(F.concat(F.lit('"trade_id":'), quoted(F.when(k == 1, "").otherwise(F.col("trade_id"))))),
        F.when(k == 9, None)
        .when(k == 6, F.concat(F.lit('"price":'), F.col("price").cast("decimal(18,2)").cast("string")))
        .otherwise(F.concat(F.lit('"price":'), quoted(
            F.when(k == 3, "0").when(k == 11, "12345678901.5").otherwise(F.col("price").cast("string"))))),
        F.concat(F.lit('"size":'), quoted(F.when(k == 4, "-1.5").otherwise(F.col("size").cast("string")))),
        F.concat(F.lit('"side":'), F.when(k == 8, F.lit("1")).otherwise(quoted(
            F.when(k == 2, "hold").when(k == 7, F.upper("side")).otherwise(F.col("side"))))),
        F.concat(F.lit('"time":'), quoted(F.concat(_iso("traded_at"), F.when(k == 5, "").otherwise(F.lit("Z"))))),
        F.concat(F.lit('"product_id":'), quoted(F.col("product_id"))),
    ]
    return trades.select(F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}")).alias("raw"))


def frames(events: DataFrame) -> DataFrame:
    """One feed line per event, built row by row.

    Most lines are market frames with two event lists: the trade itself, and its
    mirror (id suffixed ``-m``, other side) beside an empty list. Depending on
    event type and size some are heartbeats, frames without lists, or no JSON.
    """
    trades = event_trades(events)
    k = F.col("size").cast("int")

    def trade(trade_id: Column, side: Column) -> Column:
        return F.struct(
            trade_id.alias("trade_id"),
            F.col("price").cast("string").alias("price"),
            F.col("size").cast("string").alias("size"),
            side.alias("side"),
            F.concat(_iso("traded_at"), F.lit("Z")).alias("time"),
            F.col("product_id").alias("product_id"),
        )

    own = trade(F.col("trade_id"), F.col("side"))
    mirror = trade(F.concat("trade_id", F.lit("-m")), F.when(F.col("side") == "buy", "sell").otherwise("buy"))
    listed = F.to_json(F.struct(
        F.lit("market_trades").alias("channel"),
        F.array(
            F.struct(F.lit("update").alias("type"), F.array(own).alias("trades")),
            F.struct(F.lit("snapshot").alias("type"), F.filter(F.array(own), lambda _: F.lit(False)).alias("trades")),
            F.struct(F.lit("update").alias("type"), F.array(mirror).alias("trades")),
        ).alias("events"),
    ))
    line = (
        F.when((F.col("product_id") == "error") & (k < 30), F.concat(F.lit('{"channel":"market_trades","events":['), "trade_id"))
        .when((F.col("product_id") == "view") & (k < 20), F.lit('{"channel":"heartbeats","events":[{"heartbeat_counter":1}]}'))
        .when((F.col("product_id") == "click") & (k < 10), F.lit('{"channel":"market_trades"}'))
        .when((F.col("product_id") == "click") & (k < 20), F.lit("[1,2,3]"))
        .otherwise(listed)
    )
    return trades.select(line.alias("raw"))
