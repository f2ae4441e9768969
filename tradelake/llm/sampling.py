"""Bounded, repeatable samples of labelled rows, for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPARE = 1.25  # a sample that chance made larger by less than this stays as it is


def remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % modulus


def _shares(df: DataFrame, label: str, most: float) -> Column | None:
    shares = {r[label]: min(1.0, most / r["count"]) for r in df.groupBy(label).count().collect()}
    return F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))[F.col(label)] if shares else None


def about(df: DataFrame, label: str, per_label: int, id_column: str = "doc_id") -> DataFrame:
    """All rows of rare labels and about ``per_label`` rows of each other one, chosen by the id's hash.

    Rows of one id go together; ``bounded`` makes up for that.
    """
    share = _shares(df, label, per_label)
    if share is None:
        return df
    return df.where(F.pmod(F.xxhash64(id_column, F.lit("sample")), F.lit(1 << 30)) < share * float(1 << 30))


def bounded(df: DataFrame, label: str, per_label: int, keys: list[str]) -> DataFrame:
    """``df`` without rows that repeat ``keys`` and label, and about ``per_label * SPARE`` rows of a label at most.

    Where ids repeat, the rows that stay are chosen by the hash of all keys.
    """
    once = df.dropDuplicates([*keys, label])
    share = _shares(once, label, per_label * SPARE)
    if share is None:
        return once
    return once.where(F.pmod(F.xxhash64(*keys, F.lit("bound")), F.lit(1 << 30)) < share * float(1 << 30))
