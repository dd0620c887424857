"""The poller as a stream: overlapping pages, restarts, late sources, broken pages."""

import json

from corvane.streaming import polled


def page(ids, day=5, token=None):
    data = [{"id": str(i), "author_id": "u", "text": f"post {i}", "created_at": f"2026-01-{day:02d}T00:{i % 60:02d}:00Z"} for i in ids]
    return json.dumps({"data": data, "includes": {"users": [{"id": "u", "username": "n", "name": "N"}]}, "meta": {"next_token": token} if token else {}})


def put(root, source, number, text):
    folder = root / source
    folder.mkdir(exist_ok=True)
    (folder / f"{number}.json").write_text(text)


def run(spark, root, out, checkpoint, dedupe=True, **options):
    spark.dataSource.register(polled.PolledSource)
    s = spark.readStream.format("polled").option("path", str(root)).options(**options).load()
    q = (polled.posts(s) if dedupe else s).writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(checkpoint)).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return sorted(((r.source, r.post_id or r.error) for r in spark.read.schema(s.schema).parquet(str(out)).collect()), key=str)


def test_a_restarted_stream_goes_on_where_it_was(spark, tmp_path):
    root, out, cp = tmp_path / "pages", tmp_path / "out", tmp_path / "cp"
    root.mkdir()
    put(root, "a.x", 1, page([11, 10], token="t"))
    put(root, "a.x", 2, page([10, 9]))  # begins with what the page before ended with
    want = [("a", "10"), ("a", "11"), ("a", "9")]
    assert run(spark, root, out, cp) == want
    assert run(spark, root, out, cp) == want  # nothing new
    put(root, "a.x", 3, page([12, 11, 10]))  # the next poll looks back
    put(root, "b.rss", 7, "<rss><channel><item><guid>g1</guid><title>A</title><link>https://a/1</link><pubDate>Mon, 05 Jan 2026 10:00:00 GMT</pubDate></item></channel></rss>")
    put(root, "b.rss", 8, "<rss><item>")
    put(root, "c.fax", 1, "x")
    (root / "note.txt").write_text("x")
    assert run(spark, root, out, cp) == sorted([*want, ("a", "12"), ("b", "g1"), ("b", "ParseError: invalid_payload")], key=str)
    assert json.loads((root / "a.x" / polled.READ).read_text()) == {"page": 3}
    put(root, "a.x", 4, page([12]))
    assert len(run(spark, root, out, cp)) == 6


def test_pages_that_were_read_may_go(spark, tmp_path):
    root, out, cp = tmp_path / "pages", tmp_path / "out", tmp_path / "cp"
    root.mkdir()
    put(root, "a.x", 1, page([1]))
    run(spark, root, out, cp)
    (root / "a.x" / "1.json").unlink()
    put(root, "a.x", 2, page([2]))
    assert run(spark, root, out, cp) == [("a", "1"), ("a", "2")]


def test_offsets_and_partitions(tmp_path):
    root = tmp_path / "pages"
    root.mkdir()
    reader = polled.PolledReader({"path": str(root), "most_pages": "2", "since": "2026-01-04T00:00:00Z"})
    assert reader.latestOffset() == {} and reader.partitions({}, {}) == []
    for k in range(5):
        put(root, "a.x", k, page([k], day=1 + k))
    first = reader.latestOffset()
    assert first == {"a.x": 1}
    second = reader.latestOffset()
    assert second == {"a.x": 3} and [[n for n, *_ in p.pages] for p in reader.partitions(first, second)] == [[2, 3]]
    again = polled.PolledReader({"path": str(root), "most_pages": "2"})  # after a restart the logged batch is planned first
    assert [[n for n, *_ in p.pages] for p in again.partitions(first, second)] == [[2, 3]] and again.latestOffset() == {"a.x": 4}
    rows = [r for p in reader.partitions({}, {"a.x": 4}) for r in reader.read(p)]
    assert [r[4] for r in rows] == ["3", "4"]  # dated from since on
    assert reader.partitions({"a.x": 4}, {"a.x": 4}) == []


def test_without_deduplication_every_copy_comes(spark, tmp_path):
    root = tmp_path / "pages"
    root.mkdir()
    put(root, "a.x", 1, page([2, 1]))
    put(root, "a.x", 2, page([2]))
    assert run(spark, root, tmp_path / "o", tmp_path / "c", dedupe=False) == [("a", "1"), ("a", "2"), ("a", "2")]
