"""Rows of ids that come once, told apart from those of ids that come again."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.operators.absent import BROADCAST_BYTES, ROW_OVERHEAD
from tradelake.sources.tables import staged


@contextmanager
def once_and_again(rows: DataFrame, key: str = "trade_id") -> Iterator[tuple[DataFrame | None, DataFrame | None]]:
    """Rows whose key no other row has, and all others; None where there are none.

    Only the others need to be brought together, so the messages of the first kind are neither
    shuffled nor sorted. Keys are counted by hash: a chance match puts
    a row with the others, which loses nothing. Ids that come again are broadcast by their measured number; with too
    many for that all rows count as such. Rows without a key are with the first kind.
    """
    key_hash = F.xxhash64(key)
    hashes = rows.filter(F.col(key).isNotNull()).select(key_hash.alias("_hash"))
    with staged(hashes.groupBy("_hash").count().filter("count > 1").select("_hash"), "repeats") as repeats:
        size = repeats.count() * ROW_OVERHEAD
        if not size:
            yield rows, None
        elif size > BROADCAST_BYTES:
            yield None, rows
        else:
            small, same = F.broadcast(repeats), key_hash == F.col("_hash")
            keyed = F.col(key).isNotNull()
            yield rows.join(small, same & keyed, "left_anti"), rows.join(small, same & keyed, "left_semi")
