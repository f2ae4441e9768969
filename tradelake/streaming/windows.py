"""Streaming metrics and de-duplication."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradelake.functions.dates import day_of
from tradelake.functions.numbers import exact_share, share
from tradelake.operators.metrics import vwap_measures
from tradelake.plans.gold import upsert_windows
from tradelake.schemas import VWAP_TABLE, Layout
from tradelake.streaming.options import LATENESS, trigger


def vwap_windows(trades: DataFrame, length: str = "1 minute", lateness: str = LATENESS, by: tuple[str, ...] = ()) -> DataFrame:
    """Tumbling VWAP windows over event time.

    ``window()`` keeps the watermark (``date_trunc`` would lose it). The
    aggregate has a map-side step before the state exchange.
    """
    windows = (
        trades.withColumn("traded_at", F.col("traded_at").cast("timestamp"))
        .withWatermark("traded_at", lateness)
        .groupBy(*by, F.window("traded_at", length).alias("w"))
        .agg(*vwap_measures())
    )
    return windows.select(
        *by, F.col("w.start").alias("window_start"),
        share(F.col("notional"), F.col("total_volume")).alias("vwap"),
        exact_share(F.col("notional"), F.col("total_volume")).alias("vwap_exact"),
        "notional", "total_volume", "trade_count", "high_price", "low_price",
    )


def start_vwap(windows: DataFrame, layout: Layout, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Keep the gold VWAP table current from a stream.

    Update mode hands over every changed window, open ones too; each batch
    replaces them by key, so a replayed batch leaves the same table.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        stamped = batch.withColumns({"updated_at": F.current_timestamp(), "window_date": day_of("window_start")})
        upsert_windows(stamped, layout, VWAP_TABLE)

    return (
        windows.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(available_now))
        .foreachBatch(sink)
        .start()
    )


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each id in every batch of rows."""
    for batch in batches:
        codes = batch.column("trade_id").dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        _, first = np.unique(codes, return_index=True)
        yield batch if len(first) == batch.num_rows else batch.take(pa.array(np.sort(first)))


def dedup_stream(trades: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Drop re-deliveries of a trade_id within the lateness bound.

    Repeats that arrive together are dropped where they are read, without state, so a hot id
    sends a row or two for each task on to the one state, which then keeps one row per id.
    """
    timed = trades.withColumn("traded_at", F.col("traded_at").cast("timestamp"))
    first = timed.mapInArrow(_thinned, timed.schema)
    return first.withWatermark("traded_at", lateness).dropDuplicatesWithinWatermark(["trade_id"])
