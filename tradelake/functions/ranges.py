"""Numbers that a consumer has taken, as a few ranges."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ascending, separate (first, last) ranges.
Ranges = list[tuple[int, int]]
BLOCK = 4096


def outside(column: str | Column, ranges: Iterable[Sequence[int]]) -> Column:
    """Partition predicate: numbers in none of the ranges."""
    number = F.col(column) if isinstance(column, str) else column
    keep = F.lit(True)
    for first, last in ranges:
        keep = keep & ~number.between(first, last)
    return keep


def ranges_of(df: DataFrame, column: str) -> Ranges:
    """The distinct numbers of a column as ranges; the runs are found by Spark, a block of numbers at a time."""
    blocks = df.select(column).distinct().groupBy(F.floor(F.col(column) / BLOCK)).agg(F.sort_array(F.collect_list(column)).alias("n"))
    starts = F.filter("n", lambda x, i: ~F.get("n", i - 1).eqNullSafe(x - 1))
    ends = F.filter("n", lambda x, i: ~F.get("n", i + 1).eqNullSafe(x + 1))
    runs = blocks.select(F.inline(F.arrays_zip(starts.alias("first"), ends.alias("last"))))
    return merged((r["first"], r["last"]) for r in runs.collect())


def merged(*ranges: Iterable[Sequence[int]]) -> Ranges:
    """The union of ranges, with neighbours joined."""
    out: Ranges = []
    for first, last in sorted(tuple(r) for some in ranges for r in some):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out
