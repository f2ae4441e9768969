"""Keyed replacement inside day partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def merged_rows(stored: DataFrame, rows: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``stored`` rows whose key is not in ``rows``, plus all ``rows``.

    ``rows`` must be materialised and hold each key once; ``stored`` is what the days
    to be rewritten hold.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kept = stored.join(rows.select(*keys), keys, "left_anti").select(*stored.columns)
    return kept.unionByName(rows.select(*stored.columns))
