"""From feed frames to one row per trade object."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.schemas import DEFAULT_PRODUCT, FEED_CHANNEL
from tradelake.sources.feed import is_document, parse_frames


def on_channel(parsed: DataFrame, channel: str = FEED_CHANNEL) -> DataFrame:
    """Keep the frames of one channel."""
    return parsed.filter(is_document() & (F.try_variant_get("frame", "$.channel", "string") == channel))


def trades_of(parsed: DataFrame) -> DataFrame:
    """Every trade of every event as a variant ``trade``.

    Absent, null, empty or non-array lists yield nothing.
    """
    events = parsed.select(F.explode(F.try_variant_get("frame", "$.events", "array<variant>")).alias("event"))
    return events.select(F.explode(F.try_variant_get("event", "$.trades", "array<variant>")).alias("trade"))


def flatten(frames: DataFrame, channel: str = FEED_CHANNEL) -> DataFrame:
    """raw frames -> ``trade`` variants; narrow, no shuffle."""
    return trades_of(on_channel(parse_frames(frames), channel))


def of_products(trades: DataFrame, products: Sequence[str] = (DEFAULT_PRODUCT,)) -> DataFrame:
    """Keep the subscribed products."""
    if "trade" in trades.columns:
        return trades.filter(F.try_variant_get("trade", "$.product_id", "string").isin(list(products)))
    return trades.filter(F.col("product_id").isin(list(products)))
