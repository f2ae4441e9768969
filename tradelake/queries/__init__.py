"""Registered queries and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tradelake.queries import checks, commits, feed, lake, metrics, streams, trades
from tradelake.session import configure

_MODULES = (metrics, trades, feed, checks, lake, streams, commits)


def _configured(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(configure(spark), folder.rstrip("/"))
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _configured(query) for module in _MODULES for name, query in module.QUERIES.items()}


def comparison_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
