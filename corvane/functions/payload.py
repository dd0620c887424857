"""Foreign payloads as VARIANT: canonical JSON to hash, and parts of it by path.

Canonical JSON has sorted keys, no spaces, characters beyond ASCII as they are, and keeps nulls: it is how VARIANT
prints. Two things differ and are mended: control characters are escaped with small hexadecimal digits, and numbers with
a fraction or an exponent, which VARIANT reads as decimals, go through a parser that keeps them as floating point.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Escapes with capital digits, behind an even number of backslashes.
_ESCAPE = r"(?<!\\)((?:\\\\)*)\\u00([01])"
_FRACTION = r"[0-9](\.[0-9]|[eE][-+0-9])"


def _small(escaped: Column) -> Column:
    out = escaped
    for digit in "ABCDEF":
        out = F.regexp_replace(out, _ESCAPE + digit, "$1\\\\u00$2" + digit.lower())
    return F.when(escaped.contains("\\u00"), out).otherwise(escaped)


def json_text(text: Column) -> Column:
    """A text as a JSON string; a null one is empty."""
    boxed = F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("v")))
    return _small(F.substring(boxed, 6, F.char_length(boxed) - 6))


@F.pandas_udf(StringType())
def _floating(s: pd.Series) -> pd.Series:
    def one(x: str | None) -> str | None:
        try:
            return None if x is None else json.dumps(json.loads(x), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        except ValueError:
            return None

    return s.map(one)


def canonical_json(raw: Column) -> Column:
    """Canonical JSON of a payload's text; no payload is null, and a text that is no JSON counts as a string."""
    odd = raw.rlike(_FRACTION)
    native = _small(F.to_json(F.try_parse_json(raw)))
    return F.coalesce(F.when(odd, _floating(F.when(odd, raw))).otherwise(native), F.when(raw.isNotNull(), json_text(raw)), F.lit("null"))


def fingerprint(text: Column, html: Column, raw: Column) -> Column:
    """SHA-256 of the canonical JSON of what was captured: its text, its HTML and its payload."""
    return F.sha2(F.concat(F.lit('{"html":'), json_text(html), F.lit(',"raw":'), canonical_json(raw), F.lit(',"text":'), json_text(text), F.lit("}")), 256)


def part(raw: Column, path: str) -> Column:
    """JSON of a part of a payload; null where there is none or it is null."""
    found = F.try_variant_get(F.try_parse_json(raw), path, "variant")
    return F.when(~F.is_variant_null(found), F.to_json(found))


def said(found: Column) -> Column:
    """JSON that isn't empty, zero, false."""
    return F.when(~found.isin('""', "0", "false", "[]", "{}"), found)


def obj(fields: dict[str, Column]) -> Column:
    """JSON of an object of JSON values, without those that are null."""
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(json.dumps(k) + ":"), v) for k, v in sorted(fields.items())]), F.lit("}"))


def identity(platform: Column, raw: Column) -> Column:
    """JSON of the little that a platform's payload keeps in public: ids and how it was found."""
    nothing = F.lit("{}")
    whole = F.try_parse_json(raw)
    kept = (F.when(platform == "telegram", obj({"post": part(raw, "$.post")}))
            .when(platform == "x", obj({"tweet_id": part(raw, "$.tweet.id"), "collected_via": part(raw, "$.collected_via")}))
            .when(platform == "rss", obj({"entry_id": F.coalesce(said(part(raw, "$.id")), part(raw, "$.guid")), "entry_link": part(raw, "$.link")}))
            .when(platform == "web", obj({"content_type": part(raw, "$.content_type")})).otherwise(nothing))
    return F.when(F.schema_of_variant(whole).startswith("OBJECT"), kept).otherwise(nothing)
