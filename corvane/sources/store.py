"""Folders and markers in any store that Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.delete(p, True)


def mark(spark: SparkSession, path: str, text: str = "") -> None:
    """A small file; an existing one is replaced."""
    fs, p = _at(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    source = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def rename(spark: SparkSession, old: str, new: str) -> bool:
    """Move a file or folder; the target's parents are made. False if the store refused."""
    fs, a = _at(spark, old)
    b = _at(spark, new)[1]
    fs.mkdirs(b.getParent())
    return fs.rename(a, b)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, sorted; none if there is no folder."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and files below a path, of hidden ones too."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return 0, 0
    s = fs.getContentSummary(p)
    return s.getLength(), s.getFileCount()
