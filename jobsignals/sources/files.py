"""Removing folders in whatever store a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, through Spark's own file systems; absent is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
