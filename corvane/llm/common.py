"""Helpers of the training-data operators: tables in the shared folder, joins of checked size, settings."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of every contract: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: A side of a join is broadcast only if it has been counted and is no longer than this.
BROADCAST_ROWS = 50_000
#: Spark's own setting: shuffle files go with the query that made them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where unset, in local mode, one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (found or _own_dir()).rstrip("/")


@functools.cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="corvane-")


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with these settings, which are as before afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/corvane/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str, packed: bool = False) -> DataFrame:
    """Write df to the shared folder and read it again: cuts lineage, survives lost executors, and is computed once.

    packed: rows are large and compressed already; they are written as they are, in small row groups, to spare memory.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with settings(spark, {CLEANUP: "true"}):
        out = df.write.option("compression", "none" if packed else "zstd")
        if packed:
            out = out.option("parquet.block.size", str(8 << 20)).option("parquet.enable.dictionary", "false")
        out.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle_kinds(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A table of packed rows of several kinds (column ``kind``), each in a folder of its own, and the folder of all."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with settings(spark, {CLEANUP: "true", "spark.sql.maxConcurrentOutputFileWriters": "4"}):
        df.write.option("compression", "none").option("parquet.block.size", str(8 << 20)).option("parquet.enable.dictionary", "false").partitionBy("kind").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_tables(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete settled tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for df in frames:
        for f in df.inputFiles()[:1]:
            p = jvm.org.apache.hadoop.fs.Path(f).getParent()
            if "/corvane/" in p.toString():
                p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast if a count shows it to be small; else as it is, for a shuffled (skew-split) join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of words (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
