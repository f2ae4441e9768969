"""Exact-decimal helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradelake.schemas import PRICE, RATIO


def notional(price: str | Column = "price", size: str | Column = "size") -> Column:
    """price x size, kept exact."""
    price = F.col(price) if isinstance(price, str) else price
    size = F.col(size) if isinstance(size, str) else size
    return price.cast(PRICE) * size.cast(PRICE)


def share(numerator: Column, denominator: Column) -> Column:
    """Published ratio: a double, NULL when the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def exact_share(numerator: Column, denominator: Column) -> Column:
    """Ratio rounded to eight places, which never leaves the range of its inputs."""
    return (numerator / F.nullif(denominator, F.lit(0).cast("decimal(1,0)"))).cast(RATIO)
