"""Micro-batch size and pace."""

from __future__ import annotations

# Flush at this many messages or after this long.
FLUSH_ROWS = 200
FLUSH_INTERVAL = "2 seconds"
# How long a trade may arrive late before the stream stops waiting for it.
LATENESS = "30 minutes"


def trigger(available_now: bool = False, interval: str = FLUSH_INTERVAL) -> dict:
    """Arguments for ``writeStream.trigger``."""
    return {"availableNow": True} if available_now else {"processingTime": interval}


def broker_options(rows: int = FLUSH_ROWS, interval: str = "2s", ceiling: int | None = None) -> dict[str, str]:
    """Source options of a message broker: start a batch at ``rows`` waiting
    messages or after ``interval``, whichever comes first, and bound its size."""
    options = {"minOffsetsPerTrigger": str(rows), "maxTriggerDelay": interval}
    if ceiling:
        options["maxOffsetsPerTrigger"] = str(ceiling)
    return options
