"""Reading and writing the Parquet tables."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import UTC, date, datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions.ranges import Ranges
from tradelake.functions.windows import between_windows, date_parts_from, date_parts_until
from tradelake.schemas import BRONZE, DATE_PARTS, QUARANTINE, SILVER, lake_schema
from tradelake.session import scratch_path
from tradelake.sources import snapshots
from tradelake.sources.files import delete, exists
from tradelake.sources.packed import with_packed
from tradelake.sources.snapshots import Piece, Snapshot

MINUTE = 60_000_000  # microseconds


def read_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Scan with a declared schema; a missing dataset reads as no rows.

    Files written by an older schema version read their missing columns as NULL.
    """
    if not exists(spark, root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(root)


WIDER = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text if there is no other."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, WIDER) and isinstance(b, WIDER):
        return max(a, b, key=lambda t: WIDER.index(type(t)))
    exact = (*WIDER, T.DecimalType)
    if isinstance(a, exact) and isinstance(b, exact):
        whole = [t.precision - t.scale if isinstance(t, T.DecimalType) else DIGITS[type(t)] for t in (a, b)]
        scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in (a, b))
        return T.DecimalType(min(38, max(whole) + scale), scale) if max(whole) + scale <= 38 else T.DoubleType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def _footers(batches: Iterator) -> Iterator:
    """The Spark schema of every file of a batch, from its footer."""
    from pyarrow import fs, parquet
    from pyspark.sql.pandas.types import from_arrow_schema

    for batch in batches:
        schemas = []
        for file in batch["file"]:
            store, path = fs.FileSystem.from_uri(file.replace("s3a://", "s3://", 1))
            schema = parquet.read_schema(path, filesystem=store)
            own = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
            schemas.append(own.decode() if own else from_arrow_schema(schema.remove_metadata()).json())
        yield batch.assign(schema=schemas)


def union_by_name(spark: SparkSession, root: str) -> DataFrame:
    """Files of differing schema versions as one table of all their columns, types widened where they differ.

    Footers are read in tasks; files of one schema are one scan, so there are as many scans as
    versions. Columns stand in order of first appearance. Prefer ``read_table`` when the columns are known.
    """
    files = spark.read.parquet(root).inputFiles()
    listed = spark.createDataFrame([(unquote(file),) for file in sorted(files)], "file string").repartition(max(1, len(files) // 100))
    found = listed.mapInPandas(_footers, "file string, schema string")
    versions = sorted((min(r.files), r.schema, r.files) for r in found.groupBy("schema").agg(F.collect_list("file").alias("files")).collect())
    scans, types = [], {}
    for _, schema, own in versions:
        scan = spark.read.schema(T.StructType.fromJson(json.loads(schema))).option("basePath", root).parquet(*own)
        scans.append(scan)
        for column in scan.schema:
            types[column.name] = common_type(types.get(column.name, T.NullType()), column.dataType)
    cast = [scan.select(*(F.col(c).cast(types[c]).alias(c) for c in scan.columns)) for scan in scans]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def read_batches(spark: SparkSession, root: str, beyond: Ranges = ()) -> DataFrame:
    """Bronze rows of the batches outside ``beyond``, whether packed or in folders of their own."""
    return with_packed(spark, root, read_table(spark, root, BRONZE), "batch", beyond)


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    return read_batches(spark, root).select("payload", "trade_id", "received_at", "received_date")


def micros(moment: datetime) -> int:
    since = moment.astimezone(UTC) - datetime(1970, 1, 1, tzinfo=UTC)
    return (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds


def within(piece: Piece, since: datetime | None, until: datetime | None, slack: int = 0) -> bool:
    """Whether a piece may hold event times from ``since`` (less the slack) to ``until`` (more the slack)."""
    if since is None and until is None:
        return True
    if piece.low is None:  # rows without a time only
        return False
    return (since is None or piece.high >= micros(since) - slack) and (until is None or piece.low <= micros(until) + slack)


def read_silver(spark: SparkSession, root: str, since: datetime | None = None, until: datetime | None = None, snapshot: Snapshot | None = None) -> DataFrame:
    """Trades whose minute starts in ``[since, until)``: pieces by their range, then days and row groups."""
    df = snapshots.read(spark, root, SILVER, snapshot, lambda _, piece: within(piece, since, until, MINUTE))
    if since is not None:
        df = df.filter(F.col("trade_date") >= F.lit(since).cast("date"))
    if until is not None:
        df = df.filter(F.col("trade_date") <= F.lit(until).cast("date"))
    return between_windows(df, "traded_at", since, until)


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    return with_packed(spark, root, read_table(spark, root, QUARANTINE), "batch_id")


def read_gold(spark: SparkSession, root: str, table: str, since: datetime | None = None, until: datetime | None = None, by: tuple[str, ...] = (), snapshot: Snapshot | None = None) -> DataFrame:
    """Published windows with ``since < window_start`` and ``window_start < until``.

    Only pieces whose range fits are opened; the time bound alone prunes no directory of
    those, so the day bound goes with it.
    """
    df = snapshots.read(spark, root, lake_schema(table, by), snapshot, lambda _, piece: within(piece, since, until))
    if since is not None:
        df = df.filter(date_parts_from(since) & (F.col("window_start") > F.lit(since)))
    if until is not None:
        df = df.filter(date_parts_until(until) & (F.col("window_start") < F.lit(until)))
    return df


def date_part_key(day: date | None) -> str:
    """Key of a day in a dataset partitioned by year, month and day; of rows without a time for None."""
    values = (f"{day.year:04d}", f"{day.month:02d}", f"{day.day:02d}") if day else (snapshots.NO_VALUE,) * 3
    return "/".join(f"{part}={value}" for part, value in zip(DATE_PARTS, values))


def on_days(df: DataFrame, column: str, days: Sequence[date]) -> DataFrame:
    """Partition-pruned subset of a day-partitioned table."""
    return df.filter(F.col(column).isin(list(days)))


def overwrite_partition(df: DataFrame, root: str, column: str) -> None:
    """Replace just the partitions present in a small ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(root)
    )


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Materialise an intermediate result in the shared scratch folder.

    Cuts the lineage before a table that feeds the result is overwritten, and
    gives the optimiser true sizes for its join choice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)


def distinct_days(df: DataFrame, *columns: str) -> list[date]:
    """The calendar days in the given columns (one short row per day)."""
    days = df.select(F.explode(F.array(*columns)).alias("day")).filter("day is not null").distinct()
    return [row.day for row in days.collect()]
