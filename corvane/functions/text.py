"""Text and URL expressions."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from urllib.parse import quote, unquote, urljoin, urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def clean(text: Column) -> Column:
    """Runs of any white space, no-break spaces too, as one space; trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def nonblank(text: Column, default: str) -> Column:
    """text, or the default where it is null or empty."""
    return F.coalesce(F.when(text != "", text), F.lit(default))


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def public_url(url: Column) -> Column:
    """http or https, with a host, without user information and control characters."""
    return F.coalesce(url.rlike(r"(?i)^https?://[^/?#@\s]+([/?#]|$)") & ~url.rlike(r"[\x00-\x20\x7f]"), F.lit(False))


def handle(url: Column) -> Column:
    """Last path segment without a leading @."""
    path = F.regexp_replace(F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]*([^?#]*)", 1), "/+$", "")
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), "^@", "")


def scrubbed(url: Column) -> Column:
    """Without user information, query and fragment."""
    return F.regexp_replace(F.regexp_replace(url, "[?#].*$", ""), "^([a-zA-Z]+://)[^/@]*@", "$1")


def sha_id(*parts: Column, length: int = 24) -> Column:
    return F.substring(F.sha2(F.concat_ws("\n", *[F.coalesce(p, F.lit("")) for p in parts]), 256), 1, length)


def markdown(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\`*_\[\]<>])", r"\\$1")


def parse_stamp(text: Column) -> Column:
    """ISO stamps, the basic form too; null where it isn't one."""
    basic = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})(Z?)$", "$1-$2-$3T$4:$5:$6$7")
    return F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(basic))


def jaccard(a: Column, b: Column) -> Column:
    """0 where either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def whole(text: Column) -> Column:
    """A non-negative whole number, 0 where it isn't one."""
    return F.greatest(F.lit(0), F.coalesce(text.try_cast("bigint"), F.lit(0)))


def decoded(text: Column, rounds: int = 5) -> Column:
    """Percent-decoded to a fixed point; null if that takes more rounds."""
    seen = text
    for _ in range(rounds):
        seen = F.coalesce(F.try_url_decode(F.regexp_replace(seen, r"\+", "%2B")), seen)
    once = F.coalesce(F.try_url_decode(F.regexp_replace(seen, r"\+", "%2B")), seen)
    return F.when(once == seen, seen)


#: Texts that a task holds as Python objects, whatever the size of a batch.
TEXTS = 256


def by_slices(f: Callable[[list], pa.Array], texts: pa.Array) -> pa.Array:
    """f over a few texts at a time, as one array."""
    return pa.concat_arrays([f(texts.slice(k, TEXTS).to_pylist()) for k in range(0, max(1, len(texts)), TEXTS)])


@F.arrow_udf(StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    return by_slices(lambda xs: pa.array([None if x is None else unicodedata.normalize("NFKC", x) for x in xs], pa.string()), texts)


def nfkc(text: Column) -> Column:
    """Compatibility form. That of ASCII is the text itself, which doesn't leave the JVM."""
    other = F.octet_length(text) > F.char_length(text)
    return F.when(other, _nfkc(F.when(other, text))).otherwise(text)


@F.pandas_udf(StringType())
def joined_url(base: pd.Series, link: pd.Series) -> pd.Series:
    """An absolute link without its fragment."""

    def one(b: str | None, x: str | None) -> str | None:
        try:
            return urlsplit(urljoin(b or "", x or ""))._replace(fragment="").geturl()
        except ValueError:
            return None

    return pd.Series([one(b, x) for b, x in zip(base, link, strict=True)], dtype=object)


@F.pandas_udf(StringType())
def quoted(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else quote(x, safe=":/?&=#%+,;@-._~!$'*"))


def safe_href(value: str) -> str | None:
    """A public address, or a relative one that stays below its root; None for anything else."""
    value = value.strip()
    if not value or "\\" in value or re.search(r"[\x00-\x1f]", value):
        return None
    try:
        parts = urlsplit(value)
    except ValueError:
        return None
    if parts.scheme:
        return value if parts.scheme in ("http", "https") and parts.hostname and parts.username is None and parts.password is None else None
    return value if not value.startswith(("//", "#")) and safe_relative(parts.path) else None


def json_safe(value):
    """A copy of a foreign payload that holds nothing but JSON values; others as their text."""
    return json.loads(json.dumps(value, ensure_ascii=False, default=str))


def safe_relative(path: str) -> bool:
    """A relative path that stays below its root however often it is percent-decoded."""
    for _ in range(5):
        nxt = unquote(path)
        if nxt == path:
            break
        path = nxt
    else:
        return False
    return bool(path) and not re.match(r"[/\\]|[a-zA-Z][a-zA-Z0-9+.-]*:", path) and "\\" not in path and ".." not in path.split("/") and not re.search(r"[\x00-\x1f\x7f]", path)
