"""Folders of any file system that Spark can write to, through Hadoop's file system interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below `path`, sorted; none if it does not exist."""
    files, where = _at(spark, path)
    if not files.exists(where):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(where) if s.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    files, where = _at(spark, path)
    files.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the folder above the target is made."""
    files, where = _at(spark, source)
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    files.mkdirs(to.getParent())
    if not files.rename(where, to):
        raise OSError(f"cannot move {source} to {target}")
