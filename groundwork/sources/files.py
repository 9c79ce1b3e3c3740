"""Folder names and small text files on whatever file system Spark reads (metadata only, never rows of a table)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if it doesn't exist."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def complete(spark: SparkSession, path: str) -> bool:
    """Whether the write of this folder was committed."""
    fs, p = _fs(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_lines(spark: SparkSession, lines: list[str], path: str) -> None:
    """A small list, committed as a whole."""
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_lines(spark: SparkSession, path: str) -> list[str]:
    return [r[0] for r in spark.read.text(path).collect()]
