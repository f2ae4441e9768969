"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in a total order.

    Filtering ``row_number() = 1`` lets Spark limit each key inside every input
    partition before the exchange, so a key holding a third of all rows sends at
    most one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest(df: DataFrame, key: str | Sequence[str] = "trade_id", by: str = "ingested_at", ties: Sequence[str] | None = None) -> DataFrame:
    """Latest-wins: newest ``by``; equal stamps fall back to the other columns."""
    keys = {key} if isinstance(key, str) else set(key)
    if ties is None:
        ties = [c for c in df.columns if c not in keys and c != by]
    return keep_one(df, key, [F.desc(by), *[F.desc(c) for c in ties]])


def earliest(df: DataFrame, key: str | Sequence[str] = "trade_id", by: str = "received_at", ties: Sequence[str] | None = None) -> DataFrame:
    """First-wins: oldest ``by``; equal stamps fall back to the other columns."""
    keys = {key} if isinstance(key, str) else set(key)
    if ties is None:
        ties = [c for c in df.columns if c not in keys and c != by]
    return keep_one(df, key, [F.asc(by), *[F.asc(c) for c in ties]])
