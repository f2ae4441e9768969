"""Row validation of trade objects, with a reason for every broken rule.

The rules look at the JSON value's type (text or number), which a typed parse
would erase, so they work on the variant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.schemas import PRICE, SIDES

# Accepted text forms.
DECIMAL_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
UNIX_TEXT = r"^[+-]?\d+(\.\d+)?$"
NAIVE_TEXT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"
ZONED_TEXT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([Zz]|[+-]\d{2}:?\d{2})$"
# A unix time beyond this many seconds is read as milliseconds.
UNIX_SECONDS_LIMIT = 2e10


# Members read from a trade object, and those whose JSON type matters.
MEMBERS = ("trade_id", "product_id", "price", "size", "side", "time")
TYPED_MEMBERS = ("trade_id", "product_id", "price", "size", "side", "time")


def _object(trade: str) -> Column:
    """All members of a trade object at once, NULL if it is no object."""
    return F.try_variant_get(trade, "$", "struct<" + ",".join(f"{m}:variant" for m in MEMBERS) + ">")


def _members(members: str) -> Column:
    """Text of every member, and the JSON type of those that have a rule on it."""
    texts = [F.try_variant_get(f"{members}.{m}", "$", "string").alias(m) for m in MEMBERS if m != "side"]
    texts.append(F.lower(F.try_variant_get(f"{members}.side", "$", "string")).alias("side"))
    kinds = [F.coalesce(F.schema_of_variant(f"{members}.{m}"), F.lit("VOID")).alias(f"{m}_kind") for m in TYPED_MEMBERS]
    return F.struct(*texts, *kinds, F.col(members).isNotNull().alias("is_object"))


def _is_fraction(kind: Column) -> Column:
    return kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")


def _name_reason(field: str) -> Column:
    kind = F.col(f"{field}_kind")
    return (
        F.when(kind == "VOID", f"{field}_missing")
        .when(kind != "STRING", f"{field}_not_text")
        .when(F.length(field) == 0, f"{field}_empty")
    )


def _number_reason(field: str) -> Column:
    """The last three tests only concern values that are no positive silver decimal."""
    kind, text = F.col(f"{field}_kind"), F.col(field)
    return (
        F.when(kind == "VOID", f"{field}_missing")
        .when(_is_fraction(kind), f"{field}_is_float")
        .when(~kind.isin("STRING", "BIGINT"), f"{field}_not_decimal")
        .when(F.col(f"{field}_value") > 0, None)
        .when(~text.rlike(DECIMAL_TEXT), f"{field}_not_decimal")
        .when(text.try_cast("double") > 0, f"{field}_out_of_range")
        .otherwise(f"{field}_not_positive")
    )


def _side_reason() -> Column:
    kind = F.col("side_kind")
    return (
        F.when(kind == "VOID", "side_missing")
        .when(kind != "STRING", "side_not_text")
        .when(~F.col("side").isin(*SIDES), "side_unknown")
    )


def _unix_time(text: Column) -> Column:
    value = text.try_cast("double")
    seconds = F.when(F.abs(value) > UNIX_SECONDS_LIMIT, value / 1000).otherwise(value)
    return F.timestamp_micros(F.round(seconds * 1_000_000).try_cast("bigint"))


def _moment() -> Column:
    """UTC instant of an ISO text with a zone, or of a unix time."""
    kind, text = F.col("time_kind"), F.col("time")
    iso = (kind == "STRING") & text.rlike(ZONED_TEXT)
    unix = _is_fraction(kind) | (kind == "BIGINT") | ((kind == "STRING") & text.rlike(UNIX_TEXT))
    return F.when(iso, _full_form(text).try_cast("timestamp")).when(unix, _unix_time(text))


def _full_form(text: Column) -> Column:
    """The ISO text in the form the cast knows: seconds given, ``Z`` in upper case, a colon in the offset."""
    text = F.regexp_replace(text, "z$", "Z")
    text = F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.regexp_replace(text, r"^(.{13}:\d{2})(Z|[+-].*)$", "$1:00$2")


def _time_reason() -> Column:
    kind, text = F.col("time_kind"), F.col("time")
    return (
        F.when(F.col("traded_at").isNotNull(), None)
        .when(kind == "VOID", "time_missing")
        .when((kind == "STRING") & text.rlike(NAIVE_TEXT) & text.try_cast("timestamp").isNotNull(), "time_without_zone")
        .otherwise("time_not_parseable")
    )


def validate(trades: DataFrame, product_required: bool = False) -> DataFrame:
    """Type each ``trade`` variant and list the rules it breaks.

    Output: trade_id, product_id, price, size, side, traded_at, reasons (a
    comma-separated text) and, for a rejected record, its text ``raw``. An empty
    ``reasons`` means accepted. A row that passes every rule but does
    not fit the silver decimals is rejected as out of range. ``product_required``
    also rejects a record whose product is missing, empty or no text.

    Members are read, then typed, once each: a one-element inline keeps filters
    on the result from being pushed below it, where every condition would repeat
    that work. The reasons are joined as text, which stays in generated code.
    """
    objects = trades.select("trade", F.explode(F.array(_object("trade"))).alias("members"))
    members = objects.select("trade", F.inline(F.array(_members("members"))))
    typed = members.select("*", F.inline(F.array(F.struct(
        F.col("price").try_cast(PRICE).alias("price_value"),
        F.col("size").try_cast(PRICE).alias("size_value"),
        _moment().alias("traded_at"),
    ))))
    product = [_name_reason("product_id")] if product_required else []
    rules = F.concat_ws(",", _name_reason("trade_id"), *product, _number_reason("price"), _number_reason("size"), _side_reason(), _time_reason())
    broken = F.when(F.col("is_object"), rules).otherwise("trade_not_object")
    return typed.select(
        F.when(broken != "", F.to_json("trade")).alias("raw"), "trade_id", "product_id",
        F.col("price_value").alias("price"), F.col("size_value").alias("size"), "side", "traded_at",
        broken.alias("reasons"),
    )


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter("reasons = ''").drop("reasons", "raw")


def rejected(validated: DataFrame) -> DataFrame:
    """raw text and the list of reasons of each rejected record."""
    return validated.filter("reasons <> ''").select("raw", F.split("reasons", ",").alias("reasons"))


def health_counts(validated: DataFrame) -> DataFrame:
    """One row: received, valid and invalid records."""
    ok = F.col("reasons") == ""
    return validated.agg(
        F.count(F.lit(1)).alias("received"), F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid")
    )


def reason_counts(validated: DataFrame) -> DataFrame:
    """Rejections per rule; a record breaking two rules counts under both."""
    reasons = rejected(validated).select(F.explode("reasons").alias("reason"))
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("records"))
