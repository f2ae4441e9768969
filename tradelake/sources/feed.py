"""Market-feed frames: raw text lines, one JSON document each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """Batch source: column ``raw``."""
    return spark.read.text(path).withColumnRenamed("value", "raw")


def stream_frames(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming source over a landing folder: column ``raw``."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path).withColumnRenamed("value", "raw")


def parse_frames(frames: DataFrame) -> DataFrame:
    """Add ``frame`` (variant, NULL when the text is not JSON).

    The one-element explode keeps later filters from being pushed below the
    parse, which would repeat it in every condition.
    """
    return frames.select("raw", F.explode(F.array(F.try_parse_json("raw"))).alias("frame"))


def is_document(frame: str = "frame") -> Column:
    """True for a parsed frame that is a JSON object: only an object can be read as a struct.

    The schema of the whole frame would tell it too, but is made of every value in it.
    """
    return F.try_variant_get(frame, "$", "struct<channel:variant>").isNotNull()


def bad_frames(parsed: DataFrame) -> DataFrame:
    """Frames to set aside, whole: not JSON at all, or JSON that is no object."""
    reason = F.when(F.col("frame").isNull(), "frame_not_json").otherwise("frame_not_object")
    return parsed.filter(~is_document()).select("raw", F.array(reason).alias("reasons"))
