"""The index of an archive's keys: what a batch reads, growth, and appends that were broken off."""

import pytest

from corvane.sources import archive, store
from corvane.sources.key_index import KeyIndex

COLS = "id string, utc_day string"


def rows(spark, ids, day="2026-01-01"):
    return spark.createDataFrame([(i, day) for i in ids], COLS)


def ids(spark, path):
    return sorted(r.id for r in spark.read.schema(COLS).parquet(path).collect())


def test_a_batch_reads_no_more_of_a_larger_archive(spark, tmp_path):
    read = []
    for n in (20_000, 160_000):
        index = KeyIndex(spark, str(tmp_path / f"keys{n}"), bucket_bytes=8 << 10)
        index.rebuild(spark.range(n).selectExpr("concat('item-', id) AS k"))
        batch = spark.createDataFrame([(f"item-{k}",) for k in (1, n - 1, n, n + 1)], "k string")
        assert sorted(r.k for r in index.seen(batch, "k").collect()) == sorted([f"item-{n - 1}", "item-1"])
        read.append((index.bytes_read(batch, "k"), store.size(spark, index.path)[0]))
    assert read[1][1] > 5 * read[0][1]  # the index grew with the archive,
    assert read[1][0] < 2 * read[0][0]  # what the batch reads did not


def test_appends_with_an_index(spark, tmp_path):
    path = str(tmp_path / "arch")
    index = KeyIndex(spark, str(tmp_path / "keys"), bucket_bytes=512)
    assert archive.append_unique(spark, rows(spark, "abca"), path, index=index) == 3
    assert archive.append_unique(spark, rows(spark, "cd", "2026-02-01"), path, index=index) == 1  # an id of another day's partition
    for k in range(4):
        assert archive.append_unique(spark, rows(spark, [f"n{k}-{j}" for j in range(40)]), path, index=index) == 40
    assert archive.append_unique(spark, rows(spark, ["n0-1", "n3-39", "a"]), path, index=index) == 0
    assert index.version()[1] > 0 and len([n for n in store.names(spark, index.path) if n.startswith("v")]) == 1
    assert archive.append_unique(spark, spark.createDataFrame([], COLS), path, index=index) == 0
    with pytest.raises(archive.ArchiveError, match="no key"):
        archive.append_unique(spark, rows(spark, ["", "x"]), path, index=index)


def test_an_archive_without_an_index_is_indexed_first(spark, tmp_path):
    path = str(tmp_path / "arch")
    archive.append_unique(spark, rows(spark, "ab"), path)
    index = KeyIndex(spark, str(tmp_path / "keys"))
    assert archive.append_unique(spark, rows(spark, "bc"), path, index=index) == 1 and ids(spark, path) == ["a", "b", "c"]


@pytest.mark.parametrize("after_write", [False, True])
def test_an_append_that_was_broken_off(spark, tmp_path, monkeypatch, after_write):
    path, index = str(tmp_path / "arch"), KeyIndex(spark, str(tmp_path / "keys"))
    archive.append_unique(spark, rows(spark, "ab"), path, index=index)
    with monkeypatch.context() as m:
        def stop(*_):
            raise RuntimeError("killed")

        if after_write:
            m.setattr(KeyIndex, "add", stop)  # the archive has the rows, the index doesn't
        else:
            m.setattr(type(rows(spark, "a").write), "partitionBy", stop)
        with pytest.raises(RuntimeError, match="killed"):
            archive.append_unique(spark, rows(spark, "bcd"), path, index=index)
    assert index.broken()
    assert archive.append_unique(spark, rows(spark, "bcde"), path, index=index) == (1 if after_write else 3)
    assert ids(spark, path) == ["a", "b", "c", "d", "e"] and not index.broken()


def test_lazy_scans_fail_where_they_meet_a_bad_line(spark, tmp_path):
    f = tmp_path / "d.ndjson"
    f.write_text('{"id":"a","n":1}\n\n{"id":"b","n":2}\n')
    schema = spark.createDataFrame([], "id string, n int").schema
    assert [(r.id, r.n) for r in archive.read_ndjson(spark, [str(f)], schema, lazy=True).collect()] == [("a", 1), ("b", 2)]
    f.write_text('{"id":"a","n":1}\n[1]\n')
    with pytest.raises(Exception, match="not an object"):
        archive.read_ndjson(spark, [str(f)], schema, lazy=True).collect()
