"""Names in a folder, through Hadoop's file systems (any scheme Spark reads).

For folders with few entries (snapshots, markers), never for landing folders.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _open(spark, path)
    return fs.exists(hpath)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names right below ``path``, sorted; none when there is no such folder."""
    fs, hpath = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to ``path`` has been committed as a whole."""
    return exists(spark, f"{path}/_SUCCESS")


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file; raises when it is there already."""
    fs, hpath = _open(spark, path)
    fs.create(hpath, False).close()


def remove(spark: SparkSession, path: str) -> None:
    fs, hpath = _open(spark, path)
    fs.delete(hpath, True)
