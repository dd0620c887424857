"""The service loop: failures kept apart, replays, parked rows."""

import pytest

from corvane.sources import archive, committed
from corvane.streaming import loop as L

COLS = "id string, utc_day string"


class Service:
    def __init__(self, tmp_path):
        self.t, self.calls, self.broken = tmp_path, [], set()
        self.paths = {k: str(tmp_path / k) for k in ("archive", "ledger", "parked", "checkpoint")}

    def step(self, name, work=lambda df: {}, **kw):
        def run(df, batch):
            self.calls.append((name, batch))
            if name in self.broken:
                raise TimeoutError("a secret of the source")
            return work(df)

        return L.Step(name, run, **kw)

    def steps(self, spark):
        collect = self.step("collect", lambda df: {"added": archive.append_unique(spark, df, self.paths["archive"]), "status": "ok"}, essential=True, retries=1)
        return [collect, self.step("report"), self.step("status", lambda df: {"status": "partial"} if "odd" in self.broken else None)]

    def poll(self, spark, rows):
        src = str(self.t / "in")
        spark.createDataFrame(rows, COLS).coalesce(1).write.mode("append").parquet(src)
        q = L.serve(spark.readStream.schema(COLS).parquet(src), self.steps(spark), self.paths["ledger"], self.paths["parked"], self.paths["checkpoint"])
        q.awaitTermination(120)
        assert q.exception() is None

    def outcomes(self, spark):
        return sorted((r.batch, r.step, r.status, r.error, r.attempts) for r in L.ledger(spark, self.paths["ledger"]).collect())

    def ids(self, spark):
        return sorted(r.id for r in spark.read.schema(COLS).parquet(self.paths["archive"]).collect())


@pytest.fixture
def service(tmp_path):
    return Service(tmp_path)


def test_a_failing_report_leaves_ingest_and_ledger_right(spark, service):
    service.broken = {"report"}
    service.poll(spark, [("a", "2026-01-01"), ("b", "2026-01-02")])
    service.broken = set()
    service.poll(spark, [("b", "2026-01-02"), ("c", "2026-01-02")])
    assert service.ids(spark) == ["a", "b", "c"]
    assert service.outcomes(spark) == [(0, "collect", "ok", None, 1), (0, "report", "failed", "TimeoutError: unexpected_error", 1), (0, "status", "ok", None, 1), (1, "collect", "ok", None, 1), (1, "report", "ok", None, 1), (1, "status", "ok", None, 1)]
    assert [(r.batch, r.failed, r.status) for r in L.outcome(spark, service.paths["ledger"]).orderBy("batch").collect()] == [(0, 1, "partial"), (1, 0, "ok")] and L.exit_code(spark, service.paths["ledger"]) == 0
    assert "secret" not in str(L.ledger(spark, service.paths["ledger"]).collect())
    service.broken = {"odd"}  # a step that tells of a run that isn't clean
    service.poll(spark, [("d", "2026-01-02")])
    assert L.exit_code(spark, service.paths["ledger"]) == 1


def test_a_replayed_batch_runs_only_what_is_left(spark, service):
    df = spark.createDataFrame([("a", "2026-01-01")], COLS)
    service.broken = {"report"}
    run = lambda: L.run_batch(df, 7, service.steps(spark), service.paths["ledger"], service.paths["parked"])
    assert not run()
    service.broken = set()
    assert run() and run()
    assert service.calls == [("collect", 7), ("report", 7), ("status", 7), ("report", 7)] and service.ids(spark) == ["a"]


def test_rows_of_a_failed_collection_are_parked(spark, service):
    service.broken = {"collect"}
    service.poll(spark, [("a", "2026-01-01")])
    service.poll(spark, [("b", "2026-01-01")])
    assert [c for c in service.calls if c[0] == "collect"] == [("collect", 0)] * 2 + [("collect", 1)] * 2  # with its retry
    assert [o[2] for o in service.outcomes(spark)] == ["parked", "ok", "ok"] * 2
    service.broken = set()
    service.poll(spark, [("c", "2026-01-01")])
    step, schema = service.steps(spark)[0], spark.createDataFrame([], COLS).schema
    assert L.unpark(spark, step, service.paths["ledger"], service.paths["parked"], schema) == 2 and service.ids(spark) == ["a", "b", "c"]
    assert L.unpark(spark, step, service.paths["ledger"], service.paths["parked"], schema) == 0 and [r.status for r in L.outcome(spark, service.paths["ledger"]).collect()] == ["ok"] * 3
    assert committed.transactions(service.paths["parked"] + "/collect") == []
    with pytest.raises(ValueError, match="one name"):
        L.serve(None, [step, step], "", "", "")
