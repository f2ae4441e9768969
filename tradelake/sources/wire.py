"""The wire message: a flat JSON object whose decimals are strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def wire_json(trade_id="trade_id", price="price", size="size", side="side", time="traded_at", product_id: str | None = None) -> Column:
    """Serialise trade columns; a NULL member is left out."""
    members = [
        F.col(trade_id).alias("trade_id"),
        F.col(price).cast("string").alias("price"),
        F.col(size).cast("string").alias("size"),
        F.col(side).alias("side"),
        F.date_format(time, ISO_UTC).alias("time"),
    ]
    if product_id:
        members.append(F.col(product_id).alias("product_id"))
    return F.to_json(F.struct(*members))


def to_wire(trades: DataFrame) -> DataFrame:
    """One ``payload`` per validated trade, with its id."""
    product = "product_id" if "product_id" in trades.columns else None
    return trades.select(wire_json(product_id=product).alias("payload"), "trade_id")
