"""Session settings and table access shared by every query."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("corvane").config("spark.driver.memory", memory)
    for k, v in SETTINGS.items():
        b = b.config(k, v)
    spark = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data directory (any path that Spark reads)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def data_dir(default: str = "/root/testdata/sf0.001") -> str:
    return os.environ.get("CORVANE_DATA", default)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where unset, in local mode, one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (found or _own_dir()).rstrip("/")


@functools.cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="corvane-")


def settled(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: computed once, and lost executors cost nothing."""
    path = f"{shared_dir(df.sparkSession)}/corvane-plans/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop(df: DataFrame) -> None:
    """Delete a settled table that nothing reads any more."""
    for f in df.inputFiles()[:1]:
        folder = f.rsplit("/", 1)[0]
        if "/corvane-plans/" in folder:
            drop_folder(df.sparkSession, folder)
