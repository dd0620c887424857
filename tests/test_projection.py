"""The public form: canonical JSON, fingerprints, both shapes of raw, and the rules that hold for them."""

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corvane.functions import payload as N
from corvane.functions import text as T
from corvane.operators import derive as D
from corvane.operators import filters as S
from corvane.operators import quality as X
from corvane.sources import archive

PAYLOADS = [
    None, "{}", "null", "[]", '"a"', '{"b": 1, "a": {"z": null, "é": "\\u001f\\u000b\\n\\"x\\\\u001F\\t\\/"}, "A": [true, false, -3]}', '{"x": 1.0, "y": 2.50, "z": 1e3, "t": "1.0"}', '{"big": 123456789012345678901234, "s": " \\ud83d\\ude00 "}', '{"2": 1, "10": 2, "ab": 3, "a": 4}',
]
TEXTS = ["", "plain", 'quote " and \\ back', "line\nfeed\ttab\r\b\f", "ctrl \x01\x0b\x1f\x1a end \\u001F", "é 漢 😀   \x7f"]


def dump(value):
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def test_canonical_json_and_fingerprints(spark):
    rows = [(k, raw, TEXTS[k % len(TEXTS)], TEXTS[(k + 2) % len(TEXTS)]) for k, raw in enumerate(PAYLOADS)] + [(100 + k, "{}", t, t) for k, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "k int, raw string, t string, h string")
    got = {r.k: r for r in df.select("k", N.canonical_json(F.col("raw")).alias("j"), N.fingerprint(F.col("t"), F.col("h"), F.col("raw")).alias("f")).collect()}
    for k, raw, t, h in rows:
        value = None if raw is None else json.loads(raw)
        assert got[k].j == dump(value), raw
        assert got[k].f == hashlib.sha256(dump({"text": t, "html": h, "raw": value}).encode()).hexdigest()
    assert spark.range(1).select(N.canonical_json(F.lit("no { json")).alias("j")).first().j == '"no { json"'


CASES = [  # platform, payload, identity
    ("telegram", '{"post": "c/7", "views": 1}', {"post": "c/7"}), ("telegram", '{"post": null}', {}), ("telegram", '["post"]', {}), ("telegram", None, {}),
    ("x", '{"tweet": {"id": "5", "text": "t"}, "collected_via": "search"}', {"tweet_id": "5", "collected_via": "search"}), ("x", '{"tweet": "odd", "collected_via": null}', {}),
    ("rss", '{"id": "", "guid": "g", "link": "l"}', {"entry_id": "g", "entry_link": "l"}), ("rss", '{"id": "i", "guid": "g"}', {"entry_id": "i"}), ("rss", '{"id": 0, "guid": 7}', {"entry_id": 7}),
    ("web", '{"content_type": "text/html", "x": 1}', {"content_type": "text/html"}), ("other", '{"post": 1}', {}),
]


@pytest.mark.parametrize("tagged", [False, True])
def test_both_shapes_of_raw(spark, tmp_path, tagged):
    cols = "item_id int, source string, platform string, url string, published timestamp, title string, text string, media array<string>, tags array<string>, author string, html string, raw string"
    rows = [(k, "s", p, "https://u:w@h/p?q", datetime(2026, 1, 1), "t", "x" * 30, ["https://a/1", "/rel", "https://a/1"], ["op"] if tagged else [], "me", "<p>x</p>", raw) for k, (p, raw, _) in enumerate(CASES)]
    df = D.archive_projection(spark.createDataFrame(rows, cols), ["op"], r"\bposition", chars=10, media=2)
    assert X.projection(df).count() == 0
    for r in df.withColumn("j", F.to_json("raw")).collect():
        platform, raw, identity = CASES[r.item_id]
        if tagged:
            assert json.loads(r.j) == {"archive_policy": "public_redacted_v1", "redacted": True, "platform": {} if platform == "rss" else identity}
            assert (r.title, r.text, r.html, r.media, r.author) == ("", "", "", [], "")
        else:
            want = hashlib.sha256(dump({"text": "x" * 30, "html": "<p>x</p>", "raw": json.loads(raw) if raw else None}).encode()).hexdigest()
            assert json.loads(r.j) == {"archive_policy": "public_excerpt_v1", "content_sha256": want, "original_text_chars": 30, "original_html_chars": 8, "text_truncated": True, "media_count": 3, "platform": identity}
            assert (r.text, r.html, r.media, r.author) == ("x" * 10, "", ["https://a/1"], "me")
    path = str(tmp_path / "arch")
    stored = df.withColumn("utc_day", F.lit("2026-01-01")).withColumn("id", F.concat("public_id", F.col("item_id").cast("string")))
    assert archive.append_unique(spark, stored, path) == len(CASES) and archive.append_unique(spark, stored, path) == 0
    assert X.projection(spark.read.parquet(path)).count() == 0


def test_rules_of_the_public_form(spark):
    good = {"archive_policy": "public_excerpt_v1", "content_sha256": "a" * 64, "original_text_chars": 1, "original_html_chars": 0, "text_truncated": False, "media_count": 0, "platform": {}}
    hidden = {"archive_policy": "public_redacted_v1", "redacted": True, "platform": {}}
    cases = [
        (good, {}, set()), (hidden, {"text": ""}, set()), (hidden, {}, {"redacted_content"}), (hidden | {"redacted": False}, {"text": ""}, {"redacted"}), (hidden | {"more": 1}, {"text": ""}, {"redacted_fields"}), (good | {"content_sha256": "A" * 64}, {}, {"digest"}), (good | {"media_count": -1}, {}, {"counts"}),
        (good | {"media_count": "1"}, {}, {"counts"}), (good | {"text_truncated": "no"}, {}, {"truncated"}), (good | {"platform": []}, {}, {"platform"}), ({k: v for k, v in good.items() if k != "platform"}, {}, {"platform", "excerpt_fields"}), ({"archive_policy": "x"}, {}, {"policy"}), ([], {}, {"raw", "policy"}), (None, {}, {"raw"}),
        (good, {"html": "<p>"}, {"html"}), (good, {"html": None}, {"html"}), (good, {"media": ["/rel"]}, {"media_not_public"}), (good, {"media": None}, {"media"}), (good, {"title": None}, {"title"}), (good, {"tags": None}, {"tags"}),
    ]
    rows = [(k, *({"title": "", "text": "x", "html": "", "media": [], "tags": []} | over).values(), None if raw is None else json.dumps(raw)) for k, (raw, over, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "item_id int, title string, text string, html string, media array<string>, tags array<string>, raw string").withColumn("raw", F.parse_json("raw"))
    got: dict = {}
    for r in X.projection(df).collect():
        got.setdefault(int(r.key), set()).add(r.rule)
    assert [got.get(k, set()) for k in range(len(cases))] == [want for *_, want in cases]


def test_paths_of_an_artifact(spark):
    cases = {"data/raw/2024/01/02/items.ndjson": True, "data/raw/2024/01/02/errors.ndjson": False, "data/errors/2024/01/02/errors.ndjson": True, "data/state.json": True, "reports/daily/2024-01-02.md": True, "reports/weekly/2024-01-02.md": False, "/data/state.json": False, "data/../data/state.json": False, "data//state.json": True, "./data/state.json/": True, ".": False, "..": False, "data/raw/2024/1/2/items.ndjson": False, "data/state.json\n": False, "data\\state.json": False, "": False}
    df = spark.createDataFrame([(p,) for p in [*cases, None]], "p string")
    assert {r.p: r.a for r in df.select("p", S.artifact_allowed(F.col("p")).alias("a")).collect()} == cases | {None: False}
    assert df.where(S.artifact_allowed(F.col("p"), {"raw_root": "x/y"})).count() == 5
    assert [r.i for r in spark.createDataFrame([("reports/summary",), ("reports//summary/a",), ("reports/summaryx",), ("reports/weekly/x",), ("reports/weekly/../x",)], "p string").select(S.artifact_ignored(F.col("p")).alias("i")).collect()] == [True, True, False, True, False]


def test_quoting_keeps_what_addresses_may_hold(spark):
    assert spark.range(1).select(T.quoted(F.lit("https://a/b!$'*(c) d?x=é")).alias("q")).first().q == "https://a/b!$'*%28c%29%20d?x=%C3%A9"
