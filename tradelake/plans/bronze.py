"""Raw layer: stamp arrivals and append the trades not seen before."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions.dates import day_of
from tradelake.functions.ranges import Ranges
from tradelake.functions.windows import aware
from tradelake.operators.absent import absent_rows, id_bytes
from tradelake.plans.repeats import once_and_again
from tradelake.schemas import BRONZE, Layout
from tradelake.sources.files import claim, delete, names
from tradelake.sources.tables import read_batches, read_table, staged


@dataclass(frozen=True)
class IngestReport:
    attempted: int
    inserted: int

    @property
    def duplicates(self) -> int:
        return self.attempted - self.inserted


def arrivals_day(received_at: datetime) -> date:
    """The partition that a batch with this stamp goes to."""
    return received_at.astimezone(UTC).date()


def stamp(batch: DataFrame, received_at: datetime) -> DataFrame:
    """payload -> bronze columns; the whole batch carries one arrival stamp.

    The stamp is a literal, so a second action on the plan sees the same value.
    A batch that brings its ``trade_id`` along is not parsed for it again.
    """
    known = "trade_id" in batch.columns
    return batch.select(
        "payload",
        F.col("trade_id") if known else F.get_json_object("payload", "$.trade_id").alias("trade_id"),
        F.lit(aware(received_at, "received_at")).alias("received_at"),
    ).withColumn("received_date", day_of("received_at"))


def next_batch(spark: SparkSession, layout: Layout) -> int:
    """A batch number that nobody else has or gets; numbers of batches that died stay unused.

    A number is a file that only one caller can create. Older ones are removed, so the
    folder stays small however many batches there were.
    """
    taken = sorted(int(name) for name in names(spark, layout.bronze_batches) if name.isdigit())
    number = taken[-1] + 1 if taken else 1
    while not claim(spark, f"{layout.bronze_batches}/{number:012d}"):
        number += 1
    for old in taken[:-1]:
        delete(spark, f"{layout.bronze_batches}/{old:012d}")
    return number


def batches(spark: SparkSession, layout: Layout, beyond: Ranges = ()) -> DataFrame:
    """Bronze with the number of the batch that brought each row, without the batches in ``beyond``."""
    return read_batches(spark, layout.bronze, beyond)


def append(spark: SparkSession, layout: Layout, batch: DataFrame, received_at: datetime, keep: str = "first") -> IngestReport:
    """Append the rows of ``batch`` (``payload``, maybe ``trade_id``) that are new.

    Safe to repeat: a second run finds its own ids and adds nothing, however long ago the
    first was. Ids are looked up in the ledger, and in the batches that it has not seen.

    ``keep="all"`` stores every arrival instead, for feeds that correct trades by
    sending them again: silver then keeps the latest version.

    Every batch is a partition with a number of its own; the inserted rows are counted there.
    """
    if keep not in ("first", "all"):
        raise ValueError(f"unknown policy: {keep!r}")
    arrivals = stamp(batch, received_at)
    if keep == "all":
        stored = _add(spark, layout, arrivals, received_at)
        return IngestReport(stored, stored)
    # several steps read the batch, so its messages are made and parsed once
    with staged(arrivals, "arrivals") as rows:
        counts = rows.agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("trade_id").isNull()).alias("nulls"), id_bytes().alias("bytes")
        ).first()
        if not counts.rows:
            return IngestReport(0, 0)
        from tradelake.plans.ledger import LITERAL_IDS, holds_nothing, known_ids  # the ledger reads bronze

        if counts.rows > LITERAL_IDS and holds_nothing(spark, layout):
            with once_and_again(rows) as parts:
                new = absent_rows(rows, None, null_keys=counts.nulls > 0, parts=parts)
                return IngestReport(counts.rows, _add(spark, layout, new, received_at))
        known = known_ids(spark, layout, rows, counts.rows, counts.bytes)
        new = absent_rows(rows, known, null_keys=counts.nulls > 0, measured_bytes=counts.bytes)
        return IngestReport(counts.rows, _add(spark, layout, new, received_at))


def _add(spark: SparkSession, layout: Layout, rows: DataFrame, received_at: datetime) -> int:
    """Write rows as a batch of their own and count them there."""
    number = next_batch(spark, layout)
    (
        rows
        .withColumn("batch", F.lit(number).cast("long"))
        .write.mode("append")
        .partitionBy("received_date", "batch")
        .parquet(layout.bronze)
    )
    day = F.col("received_date") == F.lit(arrivals_day(received_at))
    return read_table(spark, layout.bronze, BRONZE).filter(day & (F.col("batch") == number)).count()
