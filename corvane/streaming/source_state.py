"""State of sources as keyed state of a stream, with a timer for the next due time.

An attempt (source, at, seq, status, fetched, added, error, cadence in minutes) replaces what is transient in its
source's state; what is durable, the last success, stays until a later one. Attempts may come in any order: of transient
fields the latest attempt's count (by at, then seq), of durable ones the greatest. With each success the source's timer
moves to the time when it is due again, and the stream tells when event time has passed it. `folded` is the same state
from a table of attempts, and what a replayed stream must give.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE = "source string, at timestamp, seq long, status string, fetched long, added long, error string, last_success timestamp, next_due timestamp, due boolean"
KEPT = "at_us long, seq long, status string, fetched long, added long, error string, success_us long, due_us long"
#: The provider that keyed state with timers needs.
PROVIDER = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
OK = "ok"


class SourceState(StatefulProcessor):
    """One source's state. It holds a row, however many attempts come."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", KEPT)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = tuple(self.state.get()) if self.state.exists() else None
        due = now[7] if now else None
        for r in rows:
            at, success = _us(r.at), now[6] if now else None
            late = now is not None and (at, r.seq) < (now[0], now[1])
            if r.status == OK and (success is None or at >= success):
                then = at + max(1, r.cadence or 1) * 60_000_000
                success, due = at, max(due, then) if at == success else then
            now = (*now[:6], success, due) if late else (at, r.seq, r.status, r.fetched, r.added, r.error, success, due)
        if now[7] is not None:
            for t in self.handle.listTimers():
                self.handle.deleteTimer(t)
            self.handle.registerTimer(-(-now[7] // 1000))
        self.state.update(now)
        yield _row(key[0], now, False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.state.exists():
            yield _row(key[0], tuple(self.state.get()), True)

    def close(self) -> None:
        pass


def _us(t: datetime) -> int:
    """Microseconds of a time as Spark hands it to Python, in the worker's zone."""
    return int(t.replace(microsecond=0).timestamp()) * 1_000_000 + t.microsecond


def _time(us: int | None) -> datetime | None:
    return None if us is None else datetime.fromtimestamp(us // 1_000_000).replace(microsecond=us % 1_000_000)  # noqa: DTZ006


def _row(source: str, now: tuple, due: bool) -> Row:
    at, seq, status, fetched, added, error, success, next_due = now
    return Row(source=source, at=_time(at), seq=seq, status=status, fetched=fetched, added=added, error=error, last_success=_time(success), next_due=_time(next_due), due=due)


def tracked(attempts: DataFrame, late: str = "1 hour") -> DataFrame:
    """The stream of states: a row for each source that a batch touched, and one with due set when its time has come.
    late: how far attempts may come behind the newest. The session needs PROVIDER's settings."""
    timed = attempts.withWatermark("at", late)
    return timed.groupBy("source").transformWithState(statefulProcessor=SourceState(), outputStructType=STATE, outputMode="Update", timeMode="EventTime")


def folded(attempts: DataFrame) -> DataFrame:
    """The states after a table of attempts."""
    last = F.max_by(F.struct("at", "seq", "status", "fetched", "added", "error"), F.struct("at", "seq"))
    success = F.max(F.when(F.col("status") == OK, F.struct("at", F.greatest(F.lit(1), F.coalesce("cadence", F.lit(1))).alias("cadence"))))
    g = attempts.groupBy("source").agg(last.alias("l"), success.alias("s"))
    return g.select("source", "l.*", F.col("s.at").alias("last_success"), F.timestamp_micros(F.unix_micros("s.at") + F.col("s.cadence") * 60_000_000).alias("next_due"))


def replayed(attempts: DataFrame, folder: str, late: str = "1 hour") -> DataFrame:
    """The rows of `tracked` over what a stream of attempts has now, from its last checkpoint in the folder on; with those
    of earlier calls. Rows of a batch that is run again replace those of its first run."""
    spark = attempts.sparkSession
    before = {k: spark.conf.get(k, None) for k in PROVIDER}
    for k, v in PROVIDER.items():
        spark.conf.set(k, v)
    try:
        out = tracked(attempts, late).writeStream.outputMode("update").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
        q = out.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{folder}/states/batch={n}")).start()
        q.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(STATE).parquet(f"{folder}/states")


def latest(states: DataFrame) -> DataFrame:
    """Of the rows of `tracked`, in whatever order batches wrote them, each source's last state."""
    return states.where("NOT due").groupBy("source").agg(F.max_by(F.struct("at", "seq", "status", "fetched", "added", "error", "last_success", "next_due"), F.struct("at", "seq", "last_success")).alias("l")).select("source", "l.*")
