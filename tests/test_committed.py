"""The transactional sink: all or nothing, two writers, overwriting, dead writers, errors upon a malformed past."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corvane.sources import archive, committed


def days(spark, n, of=3):
    return spark.range(0, n, 1, 4).select("id", F.concat(F.lit("2026-01-0"), (F.col("id") % of + 1).cast("string")).alias("utc_day"))


def ids(spark, path, schema):
    return sorted(r.id for r in committed.read(spark, path, schema).collect())


def test_rows_by_day(spark, tmp_path):
    path, df = str(tmp_path / "t"), days(spark, 40)
    assert ids(spark, path, df.schema) == []
    committed.write(df, path)
    committed.write(df.where("id < 0"), path)  # nothing to publish
    committed.write(df.where("id < 2").withColumn("utc_day", F.lit(None).cast("string")), path)
    assert ids(spark, path, df.schema) == sorted([*range(40), 0, 1]) and len(committed.entries(path)) == 2
    read = committed.read(spark, path, df.schema)
    assert {tuple(r) for r in read.where("utc_day IS NOT NULL").collect()} == {tuple(r) for r in df.collect()} and read.where("utc_day IS NULL").count() == 2
    one = read.where("utc_day = '2026-01-02'")
    assert "PartitionFilters: [isnotnull(utc_day" in one._jdf.queryExecution().toString() and one.count() == 13
    committed.write(days(spark, 5), path, mode="overwrite")
    assert ids(spark, path, df.schema) == list(range(5))


def test_a_killed_task_leaves_no_partial_day(spark, tmp_path):
    path = str(tmp_path / "t")
    committed.write(days(spark, 6), path)

    @F.udf("bigint")
    def dies(x):
        if x == 999:
            os._exit(1)
        return x

    before = sorted(os.listdir(path))
    with pytest.raises(Exception):  # noqa: B017  whatever Spark makes of a dead worker
        committed.write(days(spark, 1000).withColumn("id", dies("id")), path)
    assert sorted(os.listdir(path)) == before and ids(spark, path, days(spark, 1).schema) == list(range(6))


def test_writers_that_died_and_writers_at_once(spark, tmp_path):
    path, schema = str(tmp_path / "t"), days(spark, 1).schema
    committed.write(days(spark, 3), path)
    os.makedirs(f"{path}/txn=dead/utc_day=2026-01-01")
    assert ids(spark, path, schema) == [0, 1, 2] and committed.sweep(path) == ["dead"] and committed.sweep(path) == []
    numbers = [committed.publish(path, {"transaction": f"t{k}", "files": 0, "whole": False}) for k in range(3)]
    assert numbers == [1, 2, 3] and [f for f in os.listdir(f"{path}/_log") if f.startswith(".")] == []
    with pytest.raises(Exception, match="no column"):
        committed.write(days(spark, 3), path, day="none")


def test_errors_upon_a_malformed_past(spark, tmp_path):
    path = str(tmp_path / "e")
    row = lambda error, day="2026-01-01": spark.createDataFrame([("s", "https://h/", error, datetime(2026, 1, 1), day)], "source string, url string, error string, collected timestamp, utc_day string")
    committed.append_errors(row("Timeout: timeout"), path)
    committed.append_errors(row("Timeout: timeout"), path)  # errors repeat
    committed.write(row("a secret", "2026-01-02"), path)
    committed.append_errors(row("Timeout: timeout"), path)  # another day's past
    with pytest.raises(archive.ArchiveError, match="malformed"):
        committed.append_errors(row("Timeout: timeout", "2026-01-02"), path)
    assert committed.read(spark, path, row("").schema).count() == 4
