"""The service loop: steps of each micro-batch, failures kept apart, and a ledger of what became of them.

A batch runs its steps in order - collect, then reports, status and what else there is. A step that fails neither stops
the ones after it nor the query: its outcome is a row of the ledger. Rows of a batch whose essential step failed, after
its retries, are parked in a table of their own, so nothing is lost when the stream goes on, and unpark() runs that step
over them again. A batch that Spark runs again finds in the ledger what was done and leaves it; steps that were
underway when the process died run again, so they must be such as may be repeated (append_unique is).

The ledger and the parked rows are committed tables. Errors are told by category, never by message. Defined cases: an
empty batch runs its steps, as a poll without news does; a ledger that can't be written fails the query, since a batch
without an outcome must not count as done.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from corvane.operators.derive import ERROR_KINDS
from corvane.sources import committed

ROW = "batch long, step string, status string, error string, detail string, attempts int, started timestamp, finished timestamp, utc_day string"
#: Outcomes of a run's own status that count as failures of its step.
NOT_CLEAN = ("failed", "blocked", "partial")


@dataclass(frozen=True)
class Step:
    """run(rows of the batch, batch number) gives details (numbers and texts; a `status` that isn't clean is a failure)."""

    name: str
    run: Callable[[DataFrame, int], dict | None]
    essential: bool = False
    retries: int = 0


def category(error: BaseException) -> str:
    """`Type: code`, nothing of the message."""
    name = type(error).__name__
    return f"{name}: {ERROR_KINDS.get(name, 'unexpected_error')}"


def ledger(spark: SparkSession, path: str) -> DataFrame:
    return committed.read(spark, path, StructType.fromDDL(ROW))


def done(spark: SparkSession, path: str, batch: int) -> set[str]:
    """Steps of a batch that need no further run: they succeeded, or their rows were parked."""
    rows = ledger(spark, path).where((F.col("batch") == batch) & F.col("status").isin("ok", "parked")).select("step").distinct()
    return {r.step for r in rows.collect()}


def run_batch(df: DataFrame, batch: int, steps: list[Step], path: str, parked: str) -> bool:
    """Run what is left to do of a batch; whether all of it went well."""
    spark, rows, before = df.sparkSession, [], done(df.sparkSession, path, batch)
    for step in (s for s in steps if s.name not in before):
        began, error, detail, attempt = datetime.now(UTC), None, None, 0
        for attempt in range(1, step.retries + 2):
            try:
                detail, error = step.run(df, batch), None
                break
            except Exception as e:  # noqa: BLE001  whatever a step fails of
                error = category(e)
        status = "failed" if error or (detail or {}).get("status") in NOT_CLEAN else "ok"
        if error and step.essential:
            named = df.withColumns({"_batch": F.lit(batch).cast("long"), "_step": F.lit(step.name), "_day": F.lit(began.date().isoformat())})
            committed.write(named, f"{parked.rstrip('/')}/{step.name}", "_day")
            status = "parked"
        rows.append((batch, step.name, status, error, json.dumps(detail or {}, sort_keys=True, default=str), attempt, began.replace(tzinfo=None), datetime.now(UTC).replace(tzinfo=None), began.date().isoformat()))
    if rows:
        committed.write(spark.createDataFrame(rows, ROW).coalesce(1), path)
    return all(r[2] == "ok" for r in rows)


def serve(stream: DataFrame, steps: list[Step], path: str, parked: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start the loop over a stream; by default over what there is now, once."""
    if len({s.name for s in steps}) < len(steps):
        raise ValueError("two steps of one name")
    return stream.writeStream.foreachBatch(lambda df, n: run_batch(df, n, steps, path, parked) and None).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def outcome(spark: SparkSession, path: str) -> DataFrame:
    """batch, steps, failed, status of every batch, by the last outcome of each step."""
    last = ledger(spark, path).groupBy("batch", "step").agg(F.max_by("status", F.struct("finished", "status")).alias("status"))
    bad = F.count_if(F.col("status") != "ok")
    g = last.groupBy("batch").agg(F.count(F.lit(1)).alias("steps"), bad.alias("failed"))
    return g.withColumn("status", F.when(F.col("failed") == 0, "ok").when(F.col("failed") < F.col("steps"), "partial").otherwise("failed"))


def exit_code(spark: SparkSession, path: str) -> int:
    """0 if all steps of the last batch went well."""
    last = outcome(spark, path).orderBy(F.desc("batch")).first()
    return int(last is not None and last.status != "ok")


def unpark(spark: SparkSession, step: Step, path: str, parked: str, schema: StructType) -> int:
    """Run a step over the rows that it left parked, batch by batch; rows of a batch that succeeds go. Returns how many
    batches did."""
    folder = f"{parked.rstrip('/')}/{step.name}"
    full = StructType([*schema.fields]).add("_batch", "long").add("_step", "string").add("_day", "string")
    held = committed.read(spark, folder, full)
    batches = [r._batch for r in held.select("_batch").distinct().orderBy("_batch").collect()]  # a number for each failure
    good, rows = [], []
    for b in batches:
        began = datetime.now(UTC)
        try:
            detail = step.run(held.where(F.col("_batch") == b).select(*schema.names), b)
        except Exception:  # noqa: BLE001
            continue
        good.append(b)
        rows.append((b, step.name, "ok", None, json.dumps(detail or {}, sort_keys=True, default=str), 1, began.replace(tzinfo=None), datetime.now(UTC).replace(tzinfo=None), began.date().isoformat()))
    if good:
        committed.write(spark.createDataFrame(rows, ROW).coalesce(1), path)
        committed.write(held.where(~F.col("_batch").isin(good)), folder, "_day", mode="overwrite")
    return len(good)
