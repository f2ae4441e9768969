"""Day columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Partition of rows that carry no time; the not-null checks report them.
UNDATED = date(1900, 1, 1)


def day_of(ts: str) -> Column:
    return F.coalesce(F.to_date(ts), F.lit(UNDATED))
