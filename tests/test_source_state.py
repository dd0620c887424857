"""Keyed state of sources: a replayed stream gives what the table gives; timers tell who is due."""

import random
from datetime import datetime, timedelta

from corvane.streaming import source_state as S

ATTEMPT = "source string, at timestamp, seq long, status string, fetched long, added long, error string, cadence int"
T0 = datetime(2026, 1, 1)


def run(spark, tmp_path, batches):
    src, out = str(tmp_path / "in"), None
    for rows in batches:
        spark.createDataFrame(rows, ATTEMPT).coalesce(1).write.mode("append").parquet(src)
        out = S.replayed(spark.readStream.schema(ATTEMPT).parquet(src), str(tmp_path / "out"), "30 minutes")
    return out


def test_a_replayed_stream_gives_the_state_of_the_table(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for k in range(60):
        status = rng.choice(["ok", "error", "skipped_cadence"])
        rows.append((f"s{rng.randint(0, 4)}", T0 + timedelta(minutes=k // 2), k, status, k if status == "ok" else None, k % 3, "Timeout: timeout" if status == "error" else None, rng.choice([None, 5, 15])))
    batches = [rows[:20], rows[20:40], rows[40:]]
    for b in batches:
        rng.shuffle(b)
    out = run(spark, tmp_path, batches)
    want = {r.source: tuple(r) for r in S.folded(spark.createDataFrame(rows, ATTEMPT)).collect()}
    assert {r.source: tuple(r) for r in S.latest(out).collect()} == want and len(want) == 5


def test_timers(spark, tmp_path):
    at = lambda m: T0 + timedelta(minutes=m)
    batches = [
        [("a", at(0), 1, "ok", 1, 1, None, 15), ("b", at(0), 2, "error", None, None, "X: y", 15)],
        [("a", at(10), 3, "error", None, None, "X: y", 15), ("c", at(60), 4, "ok", 1, 1, None, 600)],  # the watermark passes a's time
        [("c", at(61), 5, "ok", 1, 1, None, 600)],
    ]
    out = run(spark, tmp_path, batches)
    due = out.where("due").collect()
    assert [(r.source, r.status, r.last_success, r.next_due) for r in due] == [("a", "error", at(0), at(15))]  # the success is durable, the error transient; b never succeeded
    got = {r.source: r for r in S.latest(out).collect()}
    assert (got["a"].status, got["a"].error, got["a"].last_success, got["a"].fetched) == ("error", "X: y", at(0), None) and got["c"].next_due == at(661)
