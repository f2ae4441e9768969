"""Continuous ingest: frames to bronze, bad records to quarantine."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradelake.functions.windows import utc_now
from tradelake.operators.flatten import of_products, on_channel, trades_of
from tradelake.operators.validate import accepted, health_counts, rejected, validate
from tradelake.plans import bronze
from tradelake.plans.quarantine import quarantine
from tradelake.schemas import Layout
from tradelake.sources.feed import bad_frames, parse_frames
from tradelake.sources.wire import to_wire
from tradelake.streaming.options import trigger


@dataclass(frozen=True)
class FeedReport:
    """Counts of one batch: trade records seen, and what became of them.

    ``filtered`` counts the valid records of products not subscribed to.
    """

    batch_id: str
    received: int
    valid: int
    invalid: int
    inserted: int
    duplicates: int
    filtered: int = 0


def ingest_frames(frames: DataFrame, layout: Layout, batch_id: str, products: Sequence[str] | None = None, keep: str = "first") -> FeedReport:
    """One batch of raw frames: flatten, validate, quarantine, append.

    ``keep="all"`` stores corrections of trades that bronze holds, for silver to take the latest.

    ``products`` chooses among the valid records what is stored, and
    records without a readable product are then rejected. Rejected records of every
    product are set aside.
    The parsed frames and checked records are kept for the outputs; a lost executor recomputes
    its part from the source. A bad record never stops the rest.
    """
    received_at = utc_now()
    parsed = parse_frames(frames).persist(StorageLevel.MEMORY_AND_DISK)
    checked = validate(trades_of(on_channel(parsed)), product_required=bool(products)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        health = health_counts(checked).first()
        aside = bad_frames(parsed).unionByName(rejected(checked))
        quarantine(aside.withColumns({"received_at": F.lit(received_at), "batch_id": F.lit(batch_id)}), layout)
        wanted = of_products(accepted(checked), products) if products else accepted(checked)
        stored = bronze.append(frames.sparkSession, layout, to_wire(wanted), received_at, keep)
        return FeedReport(batch_id, *health, stored.inserted, stored.duplicates, health.valid - stored.attempted)
    finally:
        checked.unpersist()
        parsed.unpersist()


def start_ingest(frames: DataFrame, layout: Layout, checkpoint: str, name: str = "ingest", products: Sequence[str] | None = None, keep: str = "first", available_now: bool = False, on_batch: Callable[[FeedReport], None] | None = None) -> StreamingQuery:
    """Run ``ingest_frames`` for every micro-batch of a stream.

    The source position is committed only after a batch is stored. A batch that
    is replayed finds its ids in bronze and its quarantine partition in place.
    ``on_batch`` receives the counts of each stored batch.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        report = ingest_frames(batch.select("raw"), layout, f"{name}-{batch_id:012d}", products, keep)
        if on_batch:
            on_batch(report)

    return (
        frames.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**trigger(available_now))
        .foreachBatch(sink)
        .start()
    )
