"""File-system calls on any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def first_time(spark: SparkSession, path: str, now_ms: int) -> int:
    """The moment written at ``path``; if nothing is there yet, ``now_ms`` is written first.  A job that
    is started again so finds the moment of its first start."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        out = fs.create(p, False)  # never over another's
        out.writeLong(now_ms)
        out.close()
    found = fs.open(p)
    try:
        return found.readLong()
    finally:
        found.close()
