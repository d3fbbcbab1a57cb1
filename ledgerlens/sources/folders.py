"""Small metadata steps on the cluster's file system: lists, marks, one-time claims."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _of(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def names(spark: SparkSession, path: str, files: bool = False) -> list[str]:
    """Names of the folders in a folder, or of its files; none if it is not there."""
    fs, target = _of(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isFile() == files)


def matches(spark: SparkSession, pattern: str, levels: int) -> list[str]:
    """Last `levels` parts of every path that fits a pattern, with one call."""
    fs, target = _of(spark, pattern)
    found = fs.globStatus(target) or []
    return sorted("/".join(str(s.getPath().toUri().getPath()).split("/")[-levels:]) for s in found)


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _of(spark, path)
    return fs.exists(target)


def size(spark: SparkSession, path: str) -> int:
    fs, target = _of(spark, path)
    return fs.getContentSummary(target).getLength()


def delete(spark: SparkSession, path: str) -> None:
    """A path that is not there is left alone."""
    fs, target = _of(spark, path)
    fs.delete(target, True)


def create_once(spark: SparkSession, path: str) -> bool:
    """Makes an empty file; False if it is there already. Of two makers one gets True."""
    fs, target = _of(spark, path)
    fs.mkdirs(target.getParent())
    if fs.getUri().getScheme() == "file":  # Hadoop's local files check and make in two steps
        return spark._jvm.java.io.File(target.toUri().getPath()).createNewFile()
    if fs.exists(target):
        return False
    try:
        fs.create(target, False).close()
    except Exception as error:
        if fs.exists(target) and "AlreadyExists" in str(error):
            return False
        raise
    return True
