"""Projections: identities, tags, delays, public and redacted forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import payload as J
from corvane.functions import text as T


def stable_id(items: DataFrame) -> Column:
    """Copies on one platform with an id space of its own converge; other items keep their source apart."""
    return T.sha_id(F.when(F.col("platform") == "x", F.lit("x")).otherwise(F.col("source")), F.col("url"), F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss'Z'"), T.clean(F.coalesce(F.when(F.col("text") != "", F.col("text")), F.col("title"))))


def lookup(values: dict, key: Column, default) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key), F.lit(default)) if values else F.lit(default)


def storage_delay(group: Column, tags: Column, source: Column, default: float, by_group: dict, by_tag: dict, by_source: dict) -> Column:
    of_tags = F.coalesce(F.array_max(F.transform(tags, lambda t: lookup(by_tag, t, 0.0))), F.lit(0.0))
    return F.greatest(F.lit(default), lookup(by_group, group, 0.0), of_tags, lookup(by_source, source, 0.0))


def merge_tags(tags: Column, detected: Column) -> Column:
    """Existing order, then the new ones sorted."""
    return F.concat(tags, F.array_sort(F.array_except(detected, tags)))


PAIR = r"(-?\d{2}\.\d{3,})\s*[,;]\s*(-?\d{2,3}\.\d{3,})"
DMS = r"(?i)\d{1,3}\s*°\s*\d{1,2}\s*['′]\s*(\d{1,2}(\.\d+)?\s*[\"″]\s*)?[NSEW]"
MGRS = r"(?i)\b\d{1,2}[C-HJ-NP-X]\s?[A-HJ-NP-Z]{2}\s?\d{4,5}\s?\d{4,5}\b"


def sensitive_tags(material: Column, context: str) -> Column:
    """precise-location for coordinates (pairs within range, degrees and minutes, grid references); with a context word
    also operational-position."""
    lat, lon = F.regexp_extract_all(material, F.lit(PAIR), F.lit(1)), F.regexp_extract_all(material, F.lit(PAIR), F.lit(2))
    pair = F.exists(F.arrays_zip(lat.alias("a"), lon.alias("b")), lambda p: (F.abs(p["a"].cast("double")) <= 90) & (F.abs(p["b"].cast("double")) <= 180))
    found = pair | material.rlike(DMS) | material.rlike(MGRS)
    return F.when(found & material.rlike(context), F.array(F.lit("operational-position"), F.lit("precise-location"))).when(found, F.array(F.lit("precise-location"))).otherwise(F.array().cast("array<string>"))


def safe_media(media: Column) -> Column:
    """Public addresses only, each once, in order."""
    return F.array_distinct(F.filter(media, T.public_url))


def public_projection(items: DataFrame, chars: int, media: int) -> DataFrame:
    """A bounded excerpt with what was cut, and bounded media."""
    n = F.char_length("text")
    return items.withColumns({"original_chars": n, "truncated": n > chars, "media_count": F.size("media"), "excerpt": F.substring("text", 1, chars), "kept_media": F.slice(safe_media(F.col("media")), 1, media), "html": F.lit("")})


def redacted_url(url: Column, platform: Column) -> Column:
    """Scheme and host, and the path on message platforms only; nothing of other schemes."""
    path = F.when(platform.isin("telegram", "x"), F.coalesce(F.nullif(F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]*(/[^?#]*)", 1), F.lit("")), F.lit("/"))).otherwise("/")
    origin = F.concat(F.regexp_extract(url, r"^([a-zA-Z]+://)", 1), F.regexp_extract(T.scrubbed(url), r"^[a-zA-Z]+://([^/?#]*)", 1))
    return F.when(url.rlike(r"^https?://[^/?#]"), F.concat(origin, path)).otherwise("")


def redacted_id(items: DataFrame) -> Column:
    """An id of where a publication was, not of what it said."""
    where = F.when(F.col("url").rlike(r"^https?://[^/?#]"), T.scrubbed(F.col("url"))).otherwise("")
    return T.sha_id(F.col("source"), F.col("platform"), where, F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def redact(items: DataFrame, tags: list[str]) -> DataFrame:
    """Tagged items keep an address (its path only on message platforms) and an id that doesn't depend on their text."""
    hide = F.coalesce(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags])), F.lit(False))
    blank = lambda c: F.when(hide, F.lit("")).otherwise(F.col(c)).alias(c)
    url = F.when(hide, redacted_url(F.col("url"), F.col("platform"))).otherwise(F.col("url"))
    return items.select("item_id", F.when(hide, redacted_id(items)).otherwise(stable_id(items)).alias("public_id"), url.alias("url"), blank("title"), blank("text"), F.when(hide, F.array().cast("array<string>")).otherwise(F.col("media")).alias("media"), hide.alias("redacted"))


def classified(items: DataFrame, context: str) -> DataFrame:
    """Items with the tags that their title, text, address and media give away merged into their own."""
    return items.withColumn("tags", merge_tags(F.coalesce("tags", F.array().cast("array<string>")), sensitive_tags(material(items), context)))


def archive_projection(items: DataFrame, redact_tags: list[str], context: str, chars: int = 1200, media: int = 8) -> DataFrame:
    """The only form in which an item enters the public archive: detected tags merged, text and media bounded, what was
    cut on record, and all content of redacted items gone.

    raw becomes a VARIANT with one of two shapes. public_excerpt_v1: content_sha256 (fingerprint of the captured text,
    HTML and payload), lengths, text_truncated, media_count, platform. public_redacted_v1: redacted and platform, where
    feeds keep nothing. raw_policy names the shape; the fields of an excerpt are columns, too. Items without html or raw
    (the payload's JSON text) have none.
    """
    c = classified(items, context)
    html = F.coalesce("html", F.lit("")) if "html" in items.columns else F.lit("")
    payload = F.col("raw") if "raw" in items.columns else F.lit(None).cast("string")
    hide = F.coalesce(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in redact_tags])), F.lit(False))
    safe = safe_media(F.slice(F.coalesce("media", F.array().cast("array<string>")), 1, media))
    text = F.coalesce("text", F.lit(""))
    new = {
        "redacted": hide, "raw_policy": F.when(hide, "public_redacted_v1").otherwise("public_excerpt_v1"), "public_id": F.when(hide, redacted_id(c)).otherwise(stable_id(c)),
        "content_sha256": F.when(~hide, J.fingerprint(text, html, payload)), "original_text_chars": F.when(~hide, F.char_length(text)), "original_html_chars": F.when(~hide, F.char_length(html)), "text_truncated": F.when(~hide, F.char_length(text) > chars),
        "media_count": F.when(~hide, F.coalesce(F.size("media"), F.lit(0))), "excerpt": F.when(hide, "").otherwise(F.substring(text, 1, chars)), "kept_media": F.when(hide, F.array().cast("array<string>")).otherwise(safe),
        "public_url": F.when(hide, redacted_url(F.col("url"), F.col("platform"))).otherwise(F.col("url")), "public_title": F.when(hide, "").otherwise(F.coalesce("title", F.lit(""))),
        "identity": F.when(hide & (F.col("platform") == "rss"), "{}").otherwise(J.identity(F.col("platform"), payload)),
    }
    out = c.withColumns(new).withColumns({"text": F.col("excerpt"), "media": F.col("kept_media"), "url": F.col("public_url"), "title": F.col("public_title"), "raw": tagged_union()})
    out = out.drop("excerpt", "kept_media", "public_url", "public_title", "identity")
    if "author" in items.columns:
        out = out.withColumn("author", F.when(F.col("redacted"), F.lit("")).otherwise(F.col("author")))
    if "html" in items.columns:
        out = out.withColumn("html", F.lit(""))
    return out


def tagged_union() -> Column:
    """raw of the archive, from the columns of archive_projection."""
    numbers = {k: F.col(k).cast("string") for k in ("original_text_chars", "original_html_chars", "text_truncated", "media_count")}
    excerpt = J.obj(numbers | {"content_sha256": F.concat(F.lit('"'), "content_sha256", F.lit('"')), "archive_policy": F.lit('"public_excerpt_v1"'), "platform": F.col("identity")})
    redacted = J.obj({"archive_policy": F.lit('"public_redacted_v1"'), "redacted": F.lit("true"), "platform": F.col("identity")})
    return F.parse_json(F.when(F.col("redacted"), redacted).otherwise(excerpt))


def section(tags: Column, group: Column, order: list[str], by_group: dict[str, str]) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for name in order:
        out = out.when(F.array_contains(tags, name), name)
    return out.otherwise(lookup(by_group, group, "other"))


def publication_mode(collected: Column, published: Column, redacted: Column, sensitive: Column, now: Column, delay: float, sensitive_delay: float) -> Column:
    """Age counts from collection first; too young is delayed, then redacted, else full."""
    age = F.greatest(F.lit(0.0), (F.unix_micros(now) - F.unix_micros(F.coalesce(collected, published))) / 3.6e9)
    need = F.when(sensitive, F.greatest(F.lit(delay), F.lit(sensitive_delay))).otherwise(F.lit(delay))
    return F.when(age < need, "delayed").when(redacted, "redacted").otherwise("full")


# The public codes of errors. A kind of exception has one code; a collection error's follows from its message.
ERROR_KINDS = {
    "Timeout": "timeout", "ReadTimeout": "timeout", "ConnectTimeout": "timeout", "TooManyRedirects": "redirect_error", "SSLError": "tls_error",
    "ConnectionError": "connection_error", "ProxyError": "connection_error", "JSONDecodeError": "invalid_json",
}
ERROR_MESSAGES = {
    "dns lookup": "dns_error", "private destination": "unsafe_destination", "unsafe url": "unsafe_destination", "cross-host redirect": "cross_host_redirect",
    "too many redirects": "redirect_error", "not configured": "missing_configuration",
}


def error_category(kind: Column, message: Column, status: Column | None = None) -> Column:
    """`Type: code`, without anything of the message but a status number. status: of the response, where there is one;
    without the argument, the status is the first number of three digits in the message."""
    code = status.cast("string") if status is not None else F.nullif(F.regexp_extract(message, r"\b([1-5]\d\d)\b", 1), F.lit(""))
    said = F.lower(message)
    api = F.regexp_extract(said, r"^x api (\d{3})", 1)
    known = F.when(said.startswith("x api "), F.when(api != "", F.concat(F.lit("x_api_http_"), api)).otherwise("x_api_error"))
    for needle, name in ERROR_MESSAGES.items():
        known = known.when(said.contains(needle), name)
    out = F.when(kind == "HTTPError", F.coalesce(F.concat(F.lit("http_"), code), F.lit("http_error"))).when(kind == "CollectionError", F.coalesce(known.otherwise("collection_error"), F.lit("collection_error")))
    return F.concat(kind, F.lit(": "), out.otherwise(lookup(ERROR_KINDS, kind, "unexpected_error")))


def virtual_sources(queries: DataFrame) -> DataFrame:
    """A source for each query (place, query) that isn't blank; ids keep the query's place, from 1."""
    q = queries.select(F.col("place").cast("long").alias("place"), F.trim("query").alias("query")).where("query <> ''")
    return q.select(F.concat(F.lit("x-discovery-"), F.col("place").cast("string")).alias("source"), "query", F.lit("x").alias("platform"))


def make_item(found: DataFrame, registry: DataFrame, now: Column | None = None) -> DataFrame:
    """Found posts as items: an id that copies share, clean texts, media once each in order, the payload as JSON, and the
    source's attributes with their defaults. Posts without a column of an item have its default; registry may have name,
    trust, tags and languages (the first counts) beside source, grp and perspective."""
    have, known = set(found.columns), set(registry.columns)
    col = lambda c, default: F.coalesce(F.col(c), default) if c in have else default
    own = {c: f"r_{c}" for c in ("grp", "perspective", "name", "trust", "tags", "languages", "platform") if c in known}
    j = found.join(registry.select("source", *[F.col(c).alias(n) for c, n in own.items()]), "source", "left")
    of = lambda c, default: T.nonblank(F.col(own[c]), default) if c in own else F.lit(default)
    none = F.array().cast("array<string>")
    language = F.try_element_at(F.col("r_languages"), F.lit(1)) if "languages" in own else (F.col("language") if "language" in have else F.lit(None))
    platform = F.col("platform") if "platform" in have else F.col("r_platform") if "platform" in own else F.lit("")
    text, title = T.clean(col("text", F.lit(""))), T.clean(col("title", F.lit("")))
    published = F.col("published") if "published" in have else F.lit(None).cast("timestamp")
    j = j.withColumns({"platform": platform, "published": published, "url": col("url", F.lit("")), "text": text, "title": title})
    return j.select(
        "item_id" if "item_id" in have else F.monotonically_increasing_id().alias("item_id"), stable_id(j).alias("id"), "source", (F.coalesce(F.col("r_name"), F.col("source")) if "name" in own else F.col("source")).alias("source_name"), "platform", "url", "published",
        (now if now is not None else col("collected", F.current_timestamp())).alias("collected"), "title", "text", col("html", F.lit("")).alias("html"), F.array_distinct(col("media", none)).alias("media"), T.clean(col("author", F.lit(""))).alias("author"),
        T.nonblank(language, "und").alias("language"), of("grp", "other").alias("grp"), of("perspective", "unknown").alias("perspective"), of("trust", "unknown").alias("trust"), (F.coalesce(F.col("r_tags"), none) if "tags" in own else none).alias("tags"), (J.canonical_json(F.col("raw")) if "raw" in have else F.lit("null")).alias("raw"))


def material(items: DataFrame) -> Column:
    """What is searched for sensitive places: title, text, address and media, in compatibility form."""
    return T.nfkc(F.concat_ws("\n", "title", "text", "url", F.array_join("media", "\n")))


def period_days(name: Column, most: int = 31) -> Column:
    """The days of a file name first_last.md; null unless it is a range of at most so many days."""
    first, last = F.regexp_extract(name, r"^(\d{4}-\d\d-\d\d)_(\d{4}-\d\d-\d\d)\.md$", 1).try_cast("date"), F.regexp_extract(name, r"^(\d{4}-\d\d-\d\d)_(\d{4}-\d\d-\d\d)\.md$", 2).try_cast("date")
    return F.when((first <= last) & (F.date_diff(last, first) < most), F.sequence(first, last))


def name_set(text: str | None) -> set[str] | None:
    """Names of a comma list; None for no list."""
    return {x.strip() for x in text.split(",") if x.strip()} if text is not None else None
