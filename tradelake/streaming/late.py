"""Trades that come behind the watermark: told, and put back into their windows.

The stream drops them, but bronze has them. ``LateRows`` counts what running streams drop,
``dropped`` what a finished one did; ``repair`` aggregates the days that the stream wrote anew
from silver, after which they hold every trade.
"""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tradelake.plans import gold, silver
from tradelake.schemas import Layout


def _dropped(progress) -> int:
    return sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)


class LateRows(StreamingQueryListener):
    """Rows dropped behind the watermark, by query id; add it with ``spark.streams.addListener``.

    Spark counts them after the map-side step of an aggregate, so a window's late trades
    of one task count once: the number is 0 exactly when no trade was dropped. A batch drops
    what lies behind the watermark that the batch before it began with.
    """

    def __init__(self) -> None:
        self.rows: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows[str(event.progress.id)] += _dropped(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def dropped(query: StreamingQuery) -> int:
    """Rows that the query's recent batches (as many as Spark keeps) dropped behind the watermark."""
    return sum(_dropped(progress) for progress in query.recentProgress)


def repair(spark: SparkSession, layout: Layout, run_at: datetime, mode: str = "strict") -> list[date]:
    """Bring silver up to date and aggregate the days that a stream wrote windows for anew; returns the days."""
    silver.upsert(spark, layout, run_at, mode)
    return gold.refresh(spark, layout, run_at, reconcile=True)
