"""The contracts of stored documents as JSON Schema. Names of fields and of what they may hold."""

from __future__ import annotations

from corvane.operators import quality as X

TEXT, SOME_TEXT, COUNT = {"type": "string"}, {"type": "string", "minLength": 1}, {"type": "integer", "minimum": 0}
TIME = {"type": "string", "format": "date-time"}
DIGEST = {"type": "string", "pattern": "^[0-9a-f]{64}$"}


def exactly(**fields) -> dict:
    """An object of these fields and no others."""
    return {"type": "object", "required": list(fields), "properties": fields, "additionalProperties": False}


EXCERPT = exactly(archive_policy={"const": "public_excerpt_v1"}, content_sha256=DIGEST, original_text_chars=COUNT, original_html_chars=COUNT, text_truncated={"type": "boolean"}, media_count=COUNT, platform={"type": "object"})
REDACTED = exactly(archive_policy={"const": "public_redacted_v1"}, redacted={"const": True}, platform={"type": "object"})
EMPTY = {"const": ""}

#: An item of the public archive: content of redacted items is empty.
ITEM = {
    "title": "item of the public archive",
    "type": "object",
    "required": ["id", "source", "platform", "url", "collected_at", "title", "text", "html", "media", "tags", "raw"],
    "properties": {
        "id": SOME_TEXT, "source": SOME_TEXT, "source_name": TEXT, "platform": {"enum": list(X.PLATFORMS)}, "url": {"type": "string", "format": "uri"}, "published_at": {"type": ["string", "null"], "format": "date-time"}, "collected_at": TIME,
        "title": TEXT, "text": TEXT, "html": EMPTY, "media": {"type": "array", "items": {"type": "string", "format": "uri"}}, "author": TEXT, "language": TEXT, "group": TEXT, "perspective": TEXT, "trust": {"enum": list(X.TRUST)}, "tags": {"type": "array", "items": TEXT}, "raw": {"oneOf": [EXCERPT, REDACTED]},
    },
    "if": {"properties": {"raw": {"properties": {"archive_policy": {"const": "public_redacted_v1"}}, "required": ["archive_policy"]}}},
    "then": {"properties": {"title": EMPTY, "text": EMPTY, "html": EMPTY, "media": {"maxItems": 0}, "author": EMPTY}},
}
#: The manifest of an artifact.
MANIFEST = exactly(
    schema=SOME_TEXT, state_status={"enum": ["ok", "idle", "partial", "blocked", "failed"]}, last_run_at={"anyOf": [TIME, {"type": "null"}]}, file_count={"type": "integer", "minimum": 1}, total_bytes=COUNT,
    files={"type": "array", "minItems": 1, "items": exactly(path=SOME_TEXT, bytes=COUNT, sha256=DIGEST)},
)
