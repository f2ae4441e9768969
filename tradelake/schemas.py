"""Schemas, table names and paths of each layer."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 8)
VOLUME = T.DecimalType(28, 8)
NOTIONAL = T.DecimalType(38, 16)
RATIO = T.DecimalType(38, 8)

# Fixed values of the public interface.
FEED_CHANNEL = "market_trades"
DEFAULT_PRODUCT = "BTC-USD"
SIDES = ("buy", "sell")
BRONZE_TABLE = "raw_trades"
SILVER_TABLE = "stg_trades"
VWAP_TABLE = "gold_vwap_1min"
STATS_TABLE = "gold_trade_stats_1min"
VIEW_NAMES = {VWAP_TABLE: "vw_vwap_1min", STATS_TABLE: "vw_trade_stats_1min"}


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# What a wire message / bronze payload holds; everything is text until silver.
PAYLOAD = _struct(
    ("trade_id", T.StringType()),
    ("price", T.StringType()),
    ("size", T.StringType()),
    ("side", T.StringType()),
    ("time", T.StringType()),
    ("product_id", T.StringType()),
)

BRONZE = _struct(
    ("payload", T.StringType()),
    ("trade_id", T.StringType()),
    ("received_at", T.TimestampType()),
    ("received_date", T.DateType()),
    ("batch", T.LongType()),
)

QUARANTINE = _struct(
    ("raw", T.StringType()),
    ("reasons", T.ArrayType(T.StringType())),
    ("received_at", T.TimestampType()),
    ("batch_id", T.StringType()),
)

SILVER = _struct(
    ("trade_id", T.StringType()),
    ("product_id", T.StringType()),
    ("price", PRICE),
    ("size", PRICE),
    ("side", T.StringType()),
    ("traded_at", T.TimestampType()),
    ("ingested_at", T.TimestampType()),
    ("trade_date", T.DateType()),
)

# Gold keeps exact sums, the state behind the volatility and a refresh stamp; PUBLISHED_* is what readers see.
GOLD_VWAP = _struct(
    ("window_start", T.TimestampType()),
    ("vwap", T.DoubleType()),
    ("vwap_exact", RATIO),
    ("notional", NOTIONAL),
    ("total_volume", VOLUME),
    ("trade_count", T.LongType()),
    ("high_price", PRICE),
    ("low_price", PRICE),
    ("updated_at", T.TimestampType()),
    ("window_date", T.DateType()),
)

GOLD_STATS = _struct(
    ("window_start", T.TimestampType()),
    ("volatility", T.DoubleType()),
    ("buy_count", T.LongType()),
    ("sell_count", T.LongType()),
    ("buy_volume_pct", T.DoubleType()),
    ("sell_volume_pct", T.DoubleType()),
    ("price_count", T.LongType()),
    ("price_mean", T.DoubleType()),
    ("price_m2", T.DoubleType()),
    ("buy_volume", VOLUME),
    ("sell_volume", VOLUME),
    ("volume", VOLUME),
    ("updated_at", T.TimestampType()),
    ("window_date", T.DateType()),
)

PUBLISHED_VWAP = _struct(
    ("window_start", T.TimestampType()),
    ("vwap", T.DoubleType()),
    ("total_volume", T.DoubleType()),
    ("trade_count", T.LongType()),
    ("high_price", T.DoubleType()),
    ("low_price", T.DoubleType()),
)

PUBLISHED_STATS = _struct(
    ("window_start", T.TimestampType()),
    ("volatility", T.DoubleType()),
    ("buy_count", T.LongType()),
    ("sell_count", T.LongType()),
    ("buy_volume_pct", T.DoubleType()),
)

EXPORT_STATE = _struct(
    ("last_exported_at", T.TimestampType()),
    ("rows_exported", T.LongType()),
    ("rows_total", T.LongType()),
    ("table_name", T.StringType()),
)

GOLD = {VWAP_TABLE: GOLD_VWAP, STATS_TABLE: GOLD_STATS}
PUBLISHED = {VWAP_TABLE: PUBLISHED_VWAP, STATS_TABLE: PUBLISHED_STATS}

DATE_PARTS = ("year", "month", "day")
_SAFE_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _texts(names) -> list[T.StructField]:
    return [T.StructField(name, T.StringType(), True) for name in names]


def gold_schema(table: str, by: tuple[str, ...] = ()) -> T.StructType:
    """A gold table's columns, led by the extra key columns."""
    return T.StructType([*_texts(by), *GOLD[table].fields])


def lake_schema(table: str, by: tuple[str, ...] = ()) -> T.StructType:
    """Published columns plus the text date parts that name the directories."""
    return T.StructType([*_texts(by), *PUBLISHED[table].fields, *_texts(DATE_PARTS)])


def safe_name(name: str) -> str:
    """Return ``name`` when it may appear in a path or in SQL, else raise."""
    if not _SAFE_NAME.fullmatch(name):
        raise ValueError(f"unsafe table name: {name!r}")
    return name


@dataclass(frozen=True)
class Layout:
    """Where each table lives below one Hadoop URI.

    ``by=("product_id",)`` keys the metrics by product and window, for a tape of
    several products; by default a window is the key.
    """

    base: str
    by: tuple[str, ...] = ()

    @property
    def window_key(self) -> list[str]:
        return [*self.by, "window_start"]

    def _at(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._at("bronze", BRONZE_TABLE)

    @property
    def quarantine(self) -> str:
        return self._at("bronze", "quarantine")

    @property
    def silver(self) -> str:
        return self._at("silver", SILVER_TABLE)

    @property
    def bronze_batches(self) -> str:
        return self._at("bronze", "batch_numbers")

    @property
    def ledger(self) -> str:
        return self._at("silver", "ledger")

    @property
    def state(self) -> str:
        return self._at("lake", "export_state")

    @property
    def checked(self) -> str:
        return self._at("gold", "checked")

    def gold(self, table: str) -> str:
        return self._at("gold", safe_name(table))

    def lake(self, table: str) -> str:
        return self._at("lake", "gold", safe_name(table))
