"""Helpers the operators share: stored steps, global ranks, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradelake.session import scratch_path

BATCH_BYTES = 4 << 20  # of rows that a worker gets at once


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared scratch root and read it back.

    The files cut the lineage: a lost executor costs a re-read, not a recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_workers(df: DataFrame, run: Callable, spec: str) -> DataFrame:
    """``df.mapInArrow`` with batches of ``BATCH_BYTES``, or a single longer row.

    Spark's own 64 MB stay with the executor, twice in the JVM's allocator and once in each worker, long after
    the step, and add up with what the next steps hold. Frames run when they are written, so the
    setting stays in the session; results must not hang on where batches end.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, spec)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand at most ``rows`` rows at once to the Python workers of what runs inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def forget(df: DataFrame) -> None:
    """Delete the files of a stored step that nothing reads any more."""
    spark = df.sparkSession
    for name in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ranked(df: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """Number all rows from 0 in ``order``, without one task seeing them all.

    Rows are sorted by ranges and stored with their place in their partition; the
    partitions' sizes (one row for each) then give every partition its start.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(placed.withColumn("_place", F.monotonically_increasing_id()), label)
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    starts = sizes.select(
        "_part", (F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")).alias("_start"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    place = F.col("_place") - F.shiftleft(F.col("_part"), 33)
    return numbered.withColumn(name, F.col("_start") + place).drop("_place", "_part", "_start")


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node in ``links(a, b)``; the component is its smallest node.

    Alternates two star contractions until nothing changes: every node hands its
    larger neighbours, then its smaller ones, to the smallest node it knows. The
    rounds grow with the logarithm of the longest path. Minima are pre-aggregated
    before the shuffle, so a hub costs one row per task.
    """
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = stored(links.where("a <> b").select(high, low).distinct(), "edges")
    while not _is_stars(edges):
        # a node that is the smaller end of several edges hands on the larger ends
        least = edges.union(edges.select("v", "u")).groupBy("u").agg(F.min("v").alias("m"))
        least = least.select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
        large = edges.join(least, "v").select("u", F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        forget(edges)
        edges = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())


def _is_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and is no smaller end."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("above"), F.lit(0).alias("below")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("node").agg(F.sum("above").alias("above"), F.max("below").alias("below"))
    return ends.where("above > 1 or above = 1 and below = 1").isEmpty()


def chunks(batches: Iterable[pa.RecordBatch], column: str, most: int, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column``'s texts stay near ``most`` bytes and ``rows``; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = text_offsets(batch.column(column))
        first = 0
        for row in range(1, batch.num_rows + 1):
            if row == batch.num_rows or row - first >= rows or ends[row + 1] - ends[first] > most:
                yield batch.slice(first, row - first)
                first = row


def text_offsets(texts: pa.Array):
    """Byte offsets of a text column (one more than rows)."""
    import numpy as np

    wide = pa.types.is_large_string(texts.type)
    kind = np.int64 if wide else np.int32
    return np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array):
    """The bytes of a text column and each row's bounds in them, without making Python strings."""
    import numpy as np

    ends = text_offsets(texts)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]
