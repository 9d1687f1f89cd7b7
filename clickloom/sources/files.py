"""Small questions to the file system behind a path, local or remote."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none if it does not exist. One listing, no data read."""
    fs, folder = _resolve(spark, path)
    if not fs.exists(folder):
        return []
    return [status.getPath().getName() for status in fs.listStatus(folder)]

