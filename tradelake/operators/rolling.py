"""Rolling VWAP over gold windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelake.functions.numbers import share

DAY = 86_400


def rolling_vwap(windows: DataFrame, seconds: int, by: Sequence[str] = ()) -> DataFrame:
    """VWAP over the ``seconds`` up to each window start, both ends included.

    One ordered window per product would put a whole product into one task.
    Time is cut into blocks at least as long as the look-back; each row joins its
    own block and, when the next block can still see it, that one as context.
    Every frame then lies inside one block, so the result is exact and blocks
    run in parallel.
    """
    span = max(DAY, seconds)
    second = F.unix_seconds(F.col("window_start").cast("timestamp"))
    block = F.floor(F.col("_second") / span)
    visible_next = F.floor((F.col("_second") + seconds) / span)
    spread = (
        windows.withColumn("_second", second)
        .withColumn("_home", block)
        .withColumn("_block", F.explode(F.sequence(block, visible_next)))
    )
    frame = Window.partitionBy(*by, "_block").orderBy("_second").rangeBetween(-seconds, 0)
    rolled = (
        spread.withColumns({"_pq": F.sum("notional").over(frame), "_q": F.sum("total_volume").over(frame)})
        .filter(F.col("_block") == F.col("_home"))
    )
    return rolled.select(
        *by, "window_start", "vwap",
        share(F.col("_pq"), F.col("_q")).alias("rolling_vwap"),
        F.col("_q").cast("double").alias("rolling_volume"),
    )
