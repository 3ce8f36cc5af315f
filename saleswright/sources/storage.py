"""Paths on whatever file system the cluster uses, through the Hadoop API."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _fs(spark, path)
    return fs.exists(jpath)


def is_directory(spark: SparkSession, path: str) -> bool:
    jpath, fs = _fs(spark, path)
    return fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly inside a folder, sorted."""
    jpath, fs = _fs(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(jpath))


def total_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file, or of everything below a folder."""
    jpath, fs = _fs(spark, path)
    return fs.getContentSummary(jpath).getLength()
