"""The schema compiler, keyword by keyword, and the contract of items."""

import json

import pytest
from pyspark.sql import functions as F

from corvane.operators import schema as S
from corvane.plans import schemas

REF = {"$defs": {"n": {"type": "integer", "minimum": 1}}, "properties": {"a": {"$ref": "#/$defs/n"}, "b": {"$ref": "#/$defs/n"}}}
CASES = [  # schema, document, violations
    ({"type": "string"}, "x", []), ({"type": "string"}, 1, ["$: type"]), ({"type": ["string", "null"]}, None, []), ({"type": "integer"}, 1.5, ["$: type"]), ({"type": "integer"}, 10**25, []), ({"type": "number"}, 1.5, []), ({"type": "number"}, True, ["$: type"]), ({"type": "boolean"}, False, []), ({"type": "array"}, {}, ["$: type"]),
    ({"enum": ["a", 1, None]}, None, []), ({"enum": ["a", 1]}, "b", ["$: enum"]), ({"const": {"b": 1, "a": [None]}}, {"a": [None], "b": 1}, []), ({"const": True}, "true", ["$: const"]),
    ({"minimum": 2}, 1, ["$: minimum"]), ({"minimum": 2}, "1", []), ({"maximum": 2}, 3.5, ["$: maximum"]), ({"exclusiveMinimum": 2}, 2, ["$: exclusiveMinimum"]), ({"exclusiveMaximum": 2}, 2, ["$: exclusiveMaximum"]),
    ({"minLength": 2}, "é", ["$: minLength"]), ({"maxLength": 1}, "é", []), ({"maxLength": 1}, "ab", ["$: maxLength"]), ({"pattern": "^a"}, "ba", ["$: pattern"]), ({"pattern": "^a"}, 5, []),
    ({"format": "date-time"}, "2026-01-02T03:04:05Z", []), ({"format": "date-time"}, "2026-13-02T03:04:05Z", ["$: format"]), ({"format": "date-time"}, "yesterday", ["$: format"]), ({"format": "uri"}, "https://a/b", []), ({"format": "uri"}, "/b", ["$: format"]), ({"format": "uri"}, None, []),
    ({"required": ["a", "b"]}, {"a": None}, ["$.b: required"]), ({"required": ["a"]}, [], []), ({"properties": {"a": {"type": "string"}}}, {"a": 1, "b": 2}, ["$.a: type"]), ({"properties": {"a": {"type": "string"}}}, {}, []), ({"properties": {"a.b": {"type": "string"}}}, {"a.b": 1}, ["$.a.b: type"]),
    ({"properties": {"a": {}}, "additionalProperties": False}, {"a": 1, "b": 2}, ["$: additionalProperties"]), ({"additionalProperties": {"type": "integer"}}, {"a": 1, "b": "x"}, ["$.*: type"]), ({"additionalProperties": {"type": "integer"}}, {}, []),
    ({"items": {"type": "integer"}}, [1, "x", "y"], ["$[]: type"]), ({"items": {"items": {"minimum": 0}}}, [[1], [-1]], ["$[][]: minimum"]), ({"items": False}, [], []), ({"minItems": 1}, [], ["$: minItems"]), ({"maxItems": 1}, [1, 2], ["$: maxItems"]), ({"uniqueItems": True}, [{"a": 1, "b": 2}, {"b": 2, "a": 1}], ["$: uniqueItems"]),
    ({"oneOf": [{"type": "integer"}, {"minimum": 2}]}, 3, ["$: oneOf"]), ({"oneOf": [{"type": "integer"}, {"minimum": 2}]}, 1, []), ({"anyOf": [{"type": "integer"}, {"type": "null"}]}, "x", ["$: anyOf"]), ({"allOf": [{"minimum": 2}, {"maximum": 0}]}, 1, ["$: maximum", "$: minimum"]), ({"not": {"type": "null"}}, None, ["$: not"]),
    ({"if": {"type": "integer"}, "then": {"minimum": 5}, "else": {"minLength": 2}}, 1, ["$: minimum"]), ({"if": {"type": "integer"}, "then": {"minimum": 5}, "else": {"minLength": 2}}, "x", ["$: minLength"]), (REF, {"a": 0, "b": 1}, ["$.a: minimum"]), (REF, {"a": "x"}, ["$.a: type"]), (True, 5, []), (False, 5, ["$: false"]),
]


@pytest.mark.parametrize("part", range(4))
def test_keywords(spark, part):
    cases = CASES[part::4]
    docs = spark.createDataFrame([(json.dumps([d for _, d, _ in cases]),)], "j string").select(F.variant_get(F.parse_json("j"), "$", "array<variant>").alias("d"))
    got = docs.select(*[S.compiled(s, F.col("d")[k]).alias(f"c{k}") for k, (s, _, _) in enumerate(cases)]).first()
    assert list(got) == [want for *_, want in cases]


def test_what_isn_t_known_is_refused(spark):
    for bad in ({"patternProperties": {}}, {"type": "text"}, {"format": "ipv4"}, {"$ref": "#/$defs/none"}, {"$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}, "$ref": "#/$defs/a"}):
        with pytest.raises(S.SchemaError):
            S.compiled(bad, F.parse_json(F.lit("1")))


def test_contract_of_items(spark):
    good = {"id": "1", "source": "s", "platform": "web", "url": "https://h/", "published_at": None, "collected_at": "2026-01-01T00:00:00Z", "title": "", "text": "", "html": "", "media": [], "tags": ["a"], "author": "", "raw": {"archive_policy": "public_redacted_v1", "redacted": True, "platform": {}}, "extra": 1}
    excerpt = {"archive_policy": "public_excerpt_v1", "content_sha256": "0" * 64, "original_text_chars": 3, "original_html_chars": 0, "text_truncated": False, "media_count": 0, "platform": {"post": 1}}
    cases = [(good, set()), (good | {"raw": excerpt, "text": "abc"}, set()), (good | {"text": "abc"}, {"$.text: const"}), (good | {"raw": excerpt | {"media_count": "0"}}, {"$.raw: oneOf"}), (good | {"media": ["x"]}, {"$.media: maxItems", "$.media[]: format"}), ({k: v for k, v in good.items() if k != "id"} | {"platform": "fax"}, {"$.id: required", "$.platform: enum"}), ("text", {"$: type"})]
    df = spark.createDataFrame([(k, json.dumps(d)) for k, (d, _) in enumerate(cases)] + [(99, None)], "k int, j string").withColumn("d", F.parse_json("j"))
    got: dict = {}
    for r in S.conforming(df, schemas.ITEM, "d", "k").collect():
        got.setdefault(int(r.key), set()).add(r.rule)
    assert [got.get(k, set()) for k in range(len(cases))] == [w for _, w in cases] and got[99] == {"$: type"}
