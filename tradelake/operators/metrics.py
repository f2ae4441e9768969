"""Windowed market metrics.

Everything is one hash aggregate with a map-side partial step: a window that
holds a third of all trades still sends one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.functions.numbers import exact_share, notional, share
from tradelake.functions.windows import bucket
from tradelake.schemas import NOTIONAL, VOLUME


def vwap_measures() -> list[Column]:
    """Sums behind the VWAP, with volume, count and price range."""
    return [
        F.sum(notional()).cast(NOTIONAL).alias("notional"),
        F.sum("size").cast(VOLUME).alias("total_volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
    ]


def _volume_of(side: Column) -> Column:
    return F.sum(F.when(side, F.col("size")).otherwise(F.lit(0).cast("decimal(18,8)"))).cast(VOLUME)


def stats_measures() -> list[Column]:
    """Volatility (NULL below two trades) and the two directions."""
    buy = F.col("side") == "buy"
    return [
        F.stddev_samp("price").alias("volatility"),
        F.count("price").alias("price_count"),
        F.avg(F.col("price").cast("double")).alias("price_mean"),
        (F.var_pop("price") * F.count("price")).alias("price_m2"),
        F.count_if(buy).alias("buy_count"),
        F.count_if(F.col("side") == "sell").alias("sell_count"),
        _volume_of(buy).alias("buy_volume"),
        _volume_of(F.col("side") == "sell").alias("sell_volume"),
        F.sum("size").cast(VOLUME).alias("volume"),
    ]


def _with_vwap(sums: DataFrame) -> DataFrame:
    return sums.withColumns({
        "vwap": share(F.col("notional"), F.col("total_volume")),
        "vwap_exact": exact_share(F.col("notional"), F.col("total_volume")),
    })


def _with_shares(sums: DataFrame) -> DataFrame:
    """Both sides' shares of the volume, each from a sum of its own, so that a check can compare them."""
    return sums.withColumns({f"{side}_volume_pct": share(F.col(f"{side}_volume") * F.lit(100), F.col("volume")) for side in ("buy", "sell")})


def vwap(trades: DataFrame, unit: str = "minute", by: Sequence[str] = ()) -> DataFrame:
    """VWAP, volume, count, high and low per window (and per ``by``)."""
    keys = [*by, bucket("traded_at", unit).alias("window_start")]
    return _with_vwap(trades.groupBy(*keys).agg(*vwap_measures()))


def trade_stats(trades: DataFrame, unit: str = "minute", by: Sequence[str] = ()) -> DataFrame:
    """Volatility and buy/sell flow per window (and per ``by``)."""
    keys = [*by, bucket("traded_at", unit).alias("window_start")]
    return _with_shares(trades.groupBy(*keys).agg(*stats_measures()))


def all_metrics(trades: DataFrame, unit: str = "minute", by: Sequence[str] = ()) -> DataFrame:
    """Both gold tables from one scan and one exchange."""
    keys = [*by, bucket("traded_at", unit).alias("window_start")]
    measures = [*vwap_measures(), *[m for m in stats_measures()]]
    return _with_shares(_with_vwap(trades.groupBy(*keys).agg(*measures)))


def merged_vwap(windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Windows of the VWAP table that stand in parts, put together: sums, counts and extremes add up exactly."""
    sums = windows.groupBy(*keys).agg(
        F.sum("notional").cast(NOTIONAL).alias("notional"), F.sum("total_volume").cast(VOLUME).alias("total_volume"),
        F.sum("trade_count").alias("trade_count"), F.max("high_price").alias("high_price"), F.min("low_price").alias("low_price"))
    return _with_vwap(sums)


def _joined_moments(parts: Column) -> Column:
    """Count, mean and sum of squared deviations of all parts, joined pairwise (parallel variance)."""
    def join(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"))

    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(F.sort_array(F.filter(parts, lambda p: p["n"] > 0)), zero, join)


def merged_stats(windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Windows of the statistics table that stand in parts, put together."""
    part = F.struct(F.col("price_count").alias("n"), F.col("price_mean").alias("mean"), F.col("price_m2").alias("m2"))
    sums = windows.groupBy(*keys).agg(
        F.collect_list(part).alias("_parts"), F.sum("buy_count").alias("buy_count"), F.sum("sell_count").alias("sell_count"),
        *[F.sum(f"{side}volume").cast(VOLUME).alias(f"{side}volume") for side in ("buy_", "sell_", "")])
    sums = sums.withColumn("_all", _joined_moments(F.col("_parts")))
    n = F.col("_all")["n"]
    sums = sums.withColumns({
        "price_count": n, "price_mean": F.when(n > 0, F.col("_all")["mean"]), "price_m2": F.when(n > 0, F.col("_all")["m2"]),
        "volatility": F.when(n > 1, F.sqrt(F.col("_all")["m2"] / (n - 1)))})
    return _with_shares(sums).drop("_parts", "_all")


def published_vwap(windows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The reader-facing columns: metrics as doubles."""
    return windows.select(
        *by, "window_start", "vwap",
        F.col("total_volume").cast("double").alias("total_volume"),
        "trade_count",
        F.col("high_price").cast("double").alias("high_price"),
        F.col("low_price").cast("double").alias("low_price"),
    )


def published_stats(windows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return windows.select(*by, "window_start", "volatility", "buy_count", "sell_count", "buy_volume_pct")
