"""Insert-if-absent: which rows of a batch are new."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.operators.dedup import earliest


# Ids are broadcast up to this measured size, and shuffled beyond it.
BROADCAST_BYTES = 128 * 1024 * 1024
ROW_OVERHEAD = 64


def id_bytes(key: str = "trade_id") -> Column:
    """Upper estimate of a hash table of the ids, as an aggregate over the batch."""
    size = F.sum(F.octet_length(key) + F.lit(ROW_OVERHEAD).cast("bigint"))
    return F.coalesce(size, F.lit(0).cast("bigint"))


def mentioned_ids(batch: DataFrame, measured_bytes: int | None, key: str = "trade_id") -> DataFrame:
    """Distinct ids of the batch, to be the right side of a semi join.

    Their measured size decides: small ones go to every task of the big scan,
    larger ones (or unmeasured ones) are left to Spark's own choice.
    """
    ids = batch.select(key).filter(F.col(key).isNotNull()).distinct()
    small = measured_bytes is not None and measured_bytes <= BROADCAST_BYTES
    return F.broadcast(ids) if small else ids


def known_keys(batch: DataFrame, table: DataFrame, key: str = "trade_id", measured_bytes: int | None = None) -> DataFrame:
    """Keys of the batch that are in ``table``."""
    return table.select(key).join(mentioned_ids(batch, measured_bytes, key), key, "left_semi").distinct()


def absent_rows(batch: DataFrame, table: DataFrame | None, key: str = "trade_id", by: str = "received_at", ties: Sequence[str] | None = None, null_keys: bool = True, measured_bytes: int | None = None, parts: tuple[DataFrame | None, DataFrame | None] | None = None) -> DataFrame:
    """Rows whose key is neither in ``table`` nor earlier in the batch.

    NULL keys never conflict; they take their own branch and are not shuffled.
    ``null_keys=False`` says that there are none and saves that branch.

    The table is first reduced by a semi join with the batch's ids, where the
    batch can be the broadcast side; a plain anti join against the table would
    always shuffle every stored id. ``table`` may be None if it holds nothing.

    ``parts`` are the batch's rows whose key comes once in it, and the others, if they are known: only the
    others are brought together then.
    """
    once, again = parts or (None, batch)
    first = [] if once is None else [once.filter(F.col(key).isNotNull())]
    if again is not None:
        first.append(earliest(again.filter(F.col(key).isNotNull()), key, by, ties))
    new = reduce(DataFrame.union, first)
    if table is not None:
        new = new.join(known_keys(batch, table, key, measured_bytes), key, "left_anti").select(*batch.columns)
    return new.union(batch.filter(F.col(key).isNull())) if null_keys else new
