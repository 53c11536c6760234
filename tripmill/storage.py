"""Metadata calls on the file system Spark itself uses (HDFS, object store, local)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.delete(target, True)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, target = _path(spark, path)
    fs.create(target, True).close()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path`` in name order; hidden and marker files left out."""
    fs, target = _path(spark, path)
    if not fs.exists(target):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(target))
    return sorted(n for n in names if not n.startswith(("_", ".")))


def rename(spark: SparkSession, old: str, new: str) -> bool:
    fs, target = _path(spark, old)
    return fs.rename(target, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new))


def create_new(spark: SparkSession, path: str, text: str) -> None:
    """A small file that must not exist yet: of two writers, one fails."""
    fs, target = _path(spark, path)
    out = fs.create(target, False)
    try:
        out.writeBytes(text)
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file of ASCII text."""
    fs, target = _path(spark, path)
    source = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "US-ASCII")
    finally:
        source.close()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.mkdirs(target)
