"""Data-quality checks.

A check is a function returning the failing rows; no rows means it passed.
``report`` counts the failures of a whole suite: all row-level checks of a table
share one aggregate pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.operators.absent import BROADCAST_BYTES, ROW_OVERHEAD
from tradelake.schemas import SIDES

# Declared limits.
PRICE_MIN, PRICE_MAX = "0.00000001", "1000000"
WARN_AFTER = timedelta(minutes=30)
ERROR_AFTER = timedelta(hours=2)
PCT_TOLERANCE = 0.001


def is_null(column: str) -> Column:
    return F.col(column).isNull()


def outside(column: str, low, high) -> Column:
    """NULL passes; the null check catches it."""
    low, high = (F.lit(bound).try_cast("decimal(38,8)") if isinstance(bound, str) else F.lit(bound) for bound in (low, high))
    return F.coalesce(~F.col(column).between(low, high), F.lit(False))


def not_accepted(column: str, values: Sequence[str]) -> Column:
    return F.coalesce(~F.col(column).isin(list(values)), F.lit(False))


def vwap_outside_bounds(vwap: str, high: str, low: str) -> Column:
    """A NULL VWAP is no failure here. Compare exact decimals, not doubles."""
    return F.coalesce(~F.col(vwap).between(F.col(low), F.col(high)), F.lit(False))


def shares_off(buy: str, sell: str, tolerance: float = PCT_TOLERANCE) -> Column:
    """Buy and sell shares that do not add up to 100, as when a trade has neither side."""
    return F.coalesce(F.abs(F.col(buy) + F.col(sell) - 100) > tolerance, F.lit(False))


def duplicated(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their count; NULL keys are skipped."""
    present = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in key))
    return df.filter(present).groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def freshness(df: DataFrame, ts: str, as_of: datetime | Column, warn_after: timedelta = WARN_AFTER, error_after: timedelta = ERROR_AFTER, by: Sequence[str] = ()) -> DataFrame:
    """Newest arrival and pass / warn / error at ``as_of``: one row, or one for each group of ``by``.

    An empty source counts as an error.
    """
    as_of = F.lit(as_of) if isinstance(as_of, datetime) else as_of
    newest = df.groupBy(*by).agg(F.max(ts).cast("timestamp").alias("newest")).withColumn("as_of", as_of.cast("timestamp"))
    age = F.unix_micros("as_of") - F.unix_micros("newest")
    limit = lambda d: F.lit(int(d.total_seconds() * 1_000_000))
    status = (
        F.when(age.isNull() | (age > limit(error_after)), "error").when(age > limit(warn_after), "warn").otherwise("pass")
    )
    return newest.withColumn("status", status)


# Checks by name; add your own with ``register``.
CHECKS: dict[str, Callable[..., DataFrame]] = {
    "not_null": lambda df, column: df.filter(is_null(column)),
    "unique": lambda df, column: duplicated(df, *([column] if isinstance(column, str) else column)),
    "accepted_values": lambda df, column, values: df.filter(not_accepted(column, values)),
    "between": lambda df, column, low, high: df.filter(outside(column, low, high)),
    "vwap_bounds": lambda df, vwap, high, low: df.filter(vwap_outside_bounds(vwap, high, low)),
    "pct_sum": lambda df, buy, sell: df.filter(shares_off(buy, sell)),
}

# The same row-level rules as predicates, so that a suite needs one pass.
_PREDICATES: dict[str, Callable[..., Column]] = {
    "not_null": is_null,
    "accepted_values": not_accepted,
    "between": outside,
    "vwap_bounds": vwap_outside_bounds,
    "pct_sum": shares_off,
}


def register(name: str, check: Callable[..., DataFrame]) -> None:
    """Add a named check ``check(df, **params) -> failing rows``."""
    CHECKS[name] = check


def run(name: str, df: DataFrame, **params) -> DataFrame:
    """The rows of ``df`` that fail one check."""
    return CHECKS[name](df, **params)


@dataclass(frozen=True)
class Check:
    """One declared check: its name in ``CHECKS``, a label, and its parameters."""

    name: str
    label: str
    params: dict = field(default_factory=dict)


def _not_null(*columns: str) -> list[Check]:
    return [Check("not_null", column, {"column": column}) for column in columns]


def fresh_source(arrivals: DataFrame, table: str, as_of: datetime) -> DataFrame:
    """The source's freshness as a row of ``report``: pass, warn or error."""
    return freshness(arrivals, "received_at", as_of).select(
        F.lit(table).alias("table"), F.lit("freshness").alias("check"), F.lit("received_at").alias("column"),
        (F.col("status") != "pass").cast("long").alias("failures"), "status")


SILVER_SUITE = [
    Check("unique", "trade_id", {"column": "trade_id"}),
    *_not_null("trade_id", "price", "size", "side", "traded_at", "ingested_at"),
    Check("accepted_values", "side", {"column": "side", "values": SIDES}),
    Check("between", "price", {"column": "price", "low": PRICE_MIN, "high": PRICE_MAX}),
]


def vwap_suite(key: Sequence[str] = ("window_start",)) -> list[Check]:
    return [Check("unique", "window_start", {"column": list(key)}), *VWAP_ROW_CHECKS]


def stats_suite(key: Sequence[str] = ("window_start",)) -> list[Check]:
    return [Check("unique", "window_start", {"column": list(key)}), *STATS_ROW_CHECKS]


VWAP_ROW_CHECKS = [
    *_not_null("window_start", "vwap", "total_volume", "trade_count", "high_price", "low_price"),
    Check("vwap_bounds", "vwap", {"vwap": "vwap_exact", "high": "high_price", "low": "low_price"}),
]

STATS_ROW_CHECKS = [
    *_not_null("window_start"),
    Check("between", "buy_volume_pct", {"column": "buy_volume_pct", "low": 0.0, "high": 100.0}),
    Check("pct_sum", "buy_volume_pct", {"buy": "buy_volume_pct", "sell": "sell_volume_pct"}),
]


def small_keys(keys: DataFrame) -> DataFrame:
    """Keys to be met by a scan: sent to its tasks up to a measured size, so that only matches are shuffled."""
    size = F.sum(sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys.columns), F.lit(ROW_OVERHEAD).cast("long")))
    return F.broadcast(keys) if (keys.agg(size).first()[0] or 0) <= BROADCAST_BYTES else keys


def report(df: DataFrame, suite: Sequence[Check], table: str, changed: DataFrame | None = None) -> DataFrame:
    """table, check, column, failures, status; one row per check.

    ``changed`` is the part that may have changed since all checks passed. Row
    checks then look at that part; a new duplicate must involve one of its keys,
    so uniqueness looks at the rows of the table that share a key with it.
    """
    one_pass = [c for c in suite if c.name in _PREDICATES]
    others = [c for c in suite if c.name not in _PREDICATES]
    parts = []
    if one_pass:
        counts = (df if changed is None else changed).agg(*[F.count_if(_PREDICATES[c.name](**c.params)).alias(f"n{i}") for i, c in enumerate(one_pass)])
        entries = [
            F.struct(F.lit(c.name).alias("check"), F.lit(c.label).alias("column"), F.col(f"n{i}").alias("failures"))
            for i, c in enumerate(one_pass)
        ]
        parts.append(counts.select(F.inline(F.array(*entries))))
    for c in others:
        rows = df
        if changed is not None and c.name == "unique":
            keys = [c.params["column"]] if isinstance(c.params["column"], str) else c.params["column"]
            rows = df.select(*keys).join(small_keys(changed.select(*keys).distinct()), keys, "left_semi")
        failing = run(c.name, rows, **c.params).agg(F.count(F.lit(1)).alias("failures"))
        parts.append(failing.select(F.lit(c.name).alias("check"), F.lit(c.label).alias("column"), "failures"))
    merged = reduce(DataFrame.unionByName, parts)
    return merged.select(
        F.lit(table).alias("table"), "check", "column", "failures",
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"),
    )
