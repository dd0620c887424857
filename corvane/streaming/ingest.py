"""Continuous ingest: each micro-batch adds the items that the archive lacks, so a replayed batch adds nothing.

The archive itself is the memory of what was seen, without a horizon; a watermark would forget. Withheld items wait in a
staging table and are released by a batch query once their delay is over.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corvane.operators import filters as S
from corvane.session import drop, drop_folder, settled
from corvane.sources.archive import append_unique, existing
from corvane.sources.key_index import KeyIndex


def ingest(stream: DataFrame, archive: str, staging: str, checkpoint: str, now: Column, delay: Column, key: str = "id", boundary: Callable[[DataFrame], DataFrame] | None = None, indexed: bool = True, **trigger) -> StreamingQuery:
    """Start a query that stores what may be stored and stages what must wait. Undated items wait for a date.

    Storable items go to the archive's day partitions, others to staging; both by key, once. boundary: the form in which
    items are stored (derive.archive_projection with its policy); rows with a text aren't stored without one, and what
    is staged has passed it, too. Its delay sees the tags that it found. indexed: the archive has an index of its keys
    beside it, so that a batch doesn't read the archive.
    """
    if boundary is None and "text" in stream.columns:
        raise ValueError("items with texts need a boundary")

    def batch(df: DataFrame, _: int) -> None:
        state = settled((boundary(df) if boundary else df).withColumn("_state", S.embargo_state(F.col("published"), now, delay)), "state")
        try:
            append_unique(df.sparkSession, state.where("_state = 'storable'").drop("_state"), archive, key, index=index_of(df.sparkSession, archive) if indexed else None)
            append_unique(df.sparkSession, state.where("_state <> 'storable'").drop("_state"), staging, key)
        finally:
            drop(state)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def index_of(spark: SparkSession, archive: str) -> KeyIndex:
    """The index of an archive's keys, beside it."""
    return KeyIndex(spark, f"{archive.rstrip('/')}.keys")


def release(spark: SparkSession, archive: str, staging: str, now: Column, delay: Column, key: str = "id", indexed: bool = True) -> int:
    """Move staged items whose delay is over into the archive; again and again without repeats. Returns how many.

    Staging keeps what still waits, as a new generation of its day partitions; rows go only once the archive has them.
    """
    if not existing(spark, [f"{staging.rstrip('/')}/utc_day=*"]):
        return 0
    state = spark.read.parquet(staging).withColumn("_state", S.embargo_state(F.col("published"), now, delay))
    n = append_unique(spark, state.where("_state = 'storable'").drop("_state"), archive, key, index=index_of(spark, archive) if indexed else None)
    days = [r.utc_day for r in state.where("_state = 'storable'").select("utc_day").distinct().collect()]  # partitions, not rows
    if days:
        rest = settled(state.where(F.col("utc_day").isin(days) & (F.col("_state") != "storable")).drop("_state"), "staging")
        rest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("utc_day").parquet(staging)
        kept = {r.utc_day for r in rest.select("utc_day").distinct().collect()}
        for d in set(days) - kept:
            drop_folder(spark, f"{staging.rstrip('/')}/utc_day={d}")
        drop(rest)
    return n


def last_clean(status: Column, completed: Column, previous: Column) -> Column:
    """When the run was last clean: this one, or as before."""
    return F.coalesce(F.when(status.isin("ok", "idle"), completed), previous)


def is_stale(last_run: Column, now: Column, poll_seconds: int) -> Column:
    limit = max(3600, 4 * poll_seconds)
    return (F.unix_micros(now) - F.unix_micros(last_run)) / 1e6 > limit
