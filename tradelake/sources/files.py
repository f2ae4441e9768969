"""The file system behind a path, as Hadoop sees it."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop(spark: SparkSession, path: str):
    """Its file system and path objects, on the driver."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = hadoop(spark, path)
    fs.delete(target, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a small folder, none if it isn't there."""
    fs, target = hadoop(spark, folder)
    return [status.getPath().getName() for status in fs.listStatus(target)] if fs.exists(target) else []


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if somebody else has."""
    fs, target = hadoop(spark, path)
    fs.mkdirs(target.getParent())
    return fs.createNewFile(target)
