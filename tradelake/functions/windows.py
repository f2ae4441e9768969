"""Time buckets, day parts, and filters that reach the scan."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.schemas import DATE_PARTS

# Start of time for an empty bookmark.
EPOCH_BOOKMARK = datetime(1900, 1, 1, tzinfo=UTC)


def bucket(ts: str | Column, unit: str = "minute") -> Column:
    """Start of the tumbling window a timestamp falls in (batch form)."""
    return F.date_trunc(unit, ts)


def between_windows(df: DataFrame, ts: str, since: datetime | None, until: datetime | None, unit: str = "minute") -> DataFrame:
    """Keep rows whose window start lies in ``[since, until)``.

    A filter on ``date_trunc(ts)`` is not turned into a bound on ``ts`` by the
    optimiser. A window start is at or past ``since`` exactly when the row is at
    or past the first window start not before ``since``, so the equivalent raw
    bound is written out and reaches the Parquet scan.
    """
    def first_start(moment: datetime) -> Column:
        start = F.date_trunc(unit, F.lit(moment))
        step = F.expr(f"INTERVAL 1 {unit}")
        return F.when(start < F.lit(moment), start + step).otherwise(start).cast(df.schema[ts].dataType)

    if since is not None:
        df = df.filter(F.col(ts) >= first_start(since))
    if until is not None:
        df = df.filter(F.col(ts) < first_start(until))
    return df


def with_date_parts(df: DataFrame, ts: str = "window_start") -> DataFrame:
    """Add zero-padded text year, month and day (the directory names)."""
    patterns = {"year": "yyyy", "month": "MM", "day": "dd"}
    return df.withColumns({part: F.date_format(ts, patterns[part]) for part in DATE_PARTS})


def date_parts_from(since: datetime | date) -> Column:
    """Partition predicate: directories on or after the day of ``since``."""
    if isinstance(since, datetime) and since.tzinfo is not None:
        since = since.astimezone(UTC)
    return F.struct(*DATE_PARTS) >= _part_values(since)


def date_parts_until(until: datetime | date) -> Column:
    """Partition predicate: directories on or before the day of ``until``."""
    if isinstance(until, datetime) and until.tzinfo is not None:
        until = until.astimezone(UTC)
    return F.struct(*DATE_PARTS) <= _part_values(until)


def _part_values(day: datetime | date) -> Column:
    return F.struct(F.lit(f"{day.year:04d}"), F.lit(f"{day.month:02d}"), F.lit(f"{day.day:02d}"))


def bookmark_max(df: DataFrame, ts: str) -> DataFrame:
    """One row: the newest ``ts``, or 1900-01-01 for an empty table."""
    return df.agg(F.coalesce(F.max(ts), F.lit(EPOCH_BOOKMARK).cast(df.schema[ts].dataType)).alias("bookmark"))


def after_bookmark(df: DataFrame, ts: str, bookmark: DataFrame, inclusive: bool = False) -> DataFrame:
    """Rows past a one-row bookmark, as an uncorrelated scalar subquery."""
    newest = bookmark.select(F.col("bookmark").cast(df.schema[ts].dataType)).scalar()
    return df.filter(F.col(ts) >= newest) if inclusive else df.filter(F.col(ts) > newest)


def utc_now() -> datetime:
    return datetime.now(UTC)


def from_micros(micros: int | None) -> datetime | None:
    """Aware UTC datetime of a microsecond count (see ``unix_micros``)."""
    if micros is None:
        return None
    seconds, rest = divmod(micros, 1_000_000)
    return datetime.fromtimestamp(seconds, UTC).replace(microsecond=rest)


def aware(moment: datetime, what: str = "timestamp") -> datetime:
    """Return ``moment`` when it carries a zone, else raise."""
    if moment.tzinfo is None or moment.utcoffset() is None:
        raise ValueError(f"{what} must be timezone-aware")
    return moment
