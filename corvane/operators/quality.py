"""Constraints as tables of violations: (scope, key, rule)."""

from __future__ import annotations

import re
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import text as T

# What may stand in the columns of sources, state and items, and the fields of the two shapes of raw.
PLATFORMS, TRUST = ("telegram", "x", "rss", "web"), ("primary", "high", "medium", "low", "unknown")
STATUSES = ("ok", "error", "skipped_config", "skipped_cadence")
#: The platform that the end of a source's id promises.
SUFFIXES = {"-tg": "telegram", "-x": "x", "-rss": "rss", "-web": "web"}
SAFE_ERROR = r"^[A-Za-z_][A-Za-z0-9_.]*: [a-z0-9_]+$"
SHAPES = {
    "public_excerpt_v1": ("archive_policy", "content_sha256", "media_count", "original_html_chars", "original_text_chars", "platform", "text_truncated"),
    "public_redacted_v1": ("archive_policy", "platform", "redacted"),
}


def check(rows: DataFrame, scope: str, key: str, rules: dict[str, Column]) -> DataFrame:
    """A row for each rule that a row breaks, from one pass; a rule's condition says what is wrong."""
    broken = F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]))
    return rows.select(F.lit(scope).alias("scope"), F.col(key).cast("string").alias("key"), F.explode(broken).alias("rule"))


def repeated(rows: DataFrame, scope: str, key: str) -> DataFrame:
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return n.select(F.lit(scope).alias("scope"), F.col(key).cast("string").alias("key"), F.lit("repeated").alias("rule"))


def registry(rows: DataFrame, perspectives: list[str] | None = None, minimums: dict[str, int] | None = None, mentioned: list[str] | None = None) -> DataFrame:
    """Rules of single sources, repeated ids, groups below their minimum, and ids that settings mention but nobody has."""
    have, id_ = set(rows.columns), F.col("source")
    more = {f"suffix{end}": id_.endswith(end) & (F.col("platform") != p) for end, p in SUFFIXES.items()}
    if "trust" in have:
        more["trust"] = ~F.coalesce(F.col("trust").isin(*TRUST), F.lit(False))
    if perspectives:
        more["perspective"] = ~F.coalesce(F.col("perspective").isin(*perspectives), F.lit(False))
    out = [_sources(rows, more), repeated(rows, "registry", "source")]
    if minimums:
        least = rows.sparkSession.createDataFrame(list(minimums.items()), "grp string, least int")
        n = rows.where("enabled").groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
        short = least.join(n, "grp", "left").where(F.coalesce("n", F.lit(0)) < F.col("least"))
        out.append(short.select(F.lit("registry").alias("scope"), F.col("grp").alias("key"), F.lit("group_minimum").alias("rule")))
    if mentioned:
        asked = rows.sparkSession.createDataFrame([(m,) for m in mentioned], "source string").join(rows, "source", "left_anti")
        out.append(asked.select(F.lit("settings").alias("scope"), F.col("source").alias("key"), F.lit("unknown_source").alias("rule")))
    return violations(*out)


def _sources(rows: DataFrame, more: dict[str, Column]) -> DataFrame:
    return check(rows, "registry", "source", more | {"empty_id": F.coalesce(F.col("source"), F.lit("")) == "", "platform": ~F.col("platform").isin(*PLATFORMS), "priority": ~F.col("priority").between(0, 100), "url": ~(T.public_url(F.col("url")) & F.col("url").startswith("https://")), "enabled": F.col("enabled").isNull(), "cadence": F.col("cadence") < 1})


def state(rows: DataFrame, known: DataFrame, last_run: Column | None = None) -> DataFrame:
    """Rules of the state of sources; last_run: nothing may have been checked after it."""
    s = rows.join(known.select(F.col("source").alias("known")).distinct(), F.col("source") == F.col("known"), "left")
    rules = {"status": ~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False)), "negative": (F.col("added") < 0) | (F.col("fetched") < 0), "order": F.col("last_success") > F.col("checked"), "unknown_source": F.col("known").isNull()}
    if last_run is not None:
        rules |= {"checked_after_run": F.col("checked") > last_run, "success_after_run": F.col("last_success") > last_run}
    if "next_due" in rows.columns:
        rules["next_due"] = (F.col("status") == "skipped_cadence") & F.col("next_due").isNull()
    if "error" in rows.columns:
        rules["error"] = (F.col("status") == "error") & ~F.coalesce(F.col("error").rlike(SAFE_ERROR), F.lit(False))
    return check(s, "state", "source", rules)


def run_state(run: DataFrame) -> DataFrame:
    """Rules of the run's own row (status, last_run, last_clean, since)."""
    clean = F.col("status").isin("ok", "idle")
    return check(run.withColumn("k", F.lit("run")), "state", "k", {
        "status": ~F.coalesce(F.col("status").isin("ok", "idle", "partial", "blocked", "failed"), F.lit(False)), "clean_without_run": F.col("last_clean").isNotNull() & F.col("last_run").isNull(),
        "clean_after_run": F.col("last_clean") > F.col("last_run"), "since_after_run": F.col("since") > F.col("last_run"), "clean_not_set": clean & F.col("last_run").isNotNull() & ~F.col("last_clean").eqNullSafe(F.col("last_run"))})


def archive(items: DataFrame, known: DataFrame) -> DataFrame:
    s = items.join(known.select(F.col("source").alias("known")).distinct(), F.col("source") == F.col("known"), "left")
    return check(s, "archive", "item_id", {"unknown_source": F.col("known").isNull(), "platform": ~F.col("platform").isin(*PLATFORMS), "trust": ~F.col("trust").isin(*TRUST), "url": ~T.public_url(F.col("url")), "undated": F.col("event_ts").isNull(), "partition": F.col("utc_day") != F.to_date("event_ts")})


def projection(items: DataFrame, key: str = "item_id") -> DataFrame:
    """Rules of the public form: no HTML, public media, raw (VARIANT) in one of its shapes with exactly its fields, and no
    content in redacted items."""
    raw = F.col("raw")
    of = lambda path, kind="string": F.try_variant_get(raw, f"$.{path}", kind)
    policy, fields = of("archive_policy"), F.array_sort(F.json_object_keys(F.to_json(raw)))
    shape = lambda name: ~fields.eqNullSafe(F.array(*[F.lit(f) for f in SHAPES[name]]))
    kind = lambda path: F.coalesce(F.schema_of_variant(F.try_variant_get(raw, f"$.{path}", "variant")), F.lit("VOID"))
    count = lambda path: ~(kind(path) == "BIGINT") | (of(path, "bigint") < 0)
    excerpt, redacted = policy == "public_excerpt_v1", policy == "public_redacted_v1"
    content = (F.coalesce("title", F.lit("")) != "") | (F.coalesce("text", F.lit("")) != "") | (F.coalesce("html", F.lit("")) != "") | (F.size(F.coalesce("media", F.array().cast("array<string>"))) > 0)
    rules = {
        "title": F.col("title").isNull(), "text": F.col("text").isNull(), "html": ~F.col("html").eqNullSafe(F.lit("")), "media": F.col("media").isNull(), "media_not_public": F.exists("media", lambda u: ~T.public_url(u)), "tags": F.col("tags").isNull(),
        "raw": ~F.coalesce(F.schema_of_variant(raw).startswith("OBJECT"), F.lit(False)), "policy": raw.isNotNull() & ~F.coalesce(policy.isin(*SHAPES), F.lit(False)),
        "excerpt_fields": excerpt & shape("public_excerpt_v1"), "digest": excerpt & ~F.coalesce(of("content_sha256").rlike("^[0-9a-f]{64}$"), F.lit(False)), "counts": excerpt & (count("original_text_chars") | count("original_html_chars") | count("media_count")),
        "truncated": excerpt & (kind("text_truncated") != "BOOLEAN"), "platform": (excerpt | redacted) & ~kind("platform").startswith("OBJECT"), "redacted_fields": redacted & shape("public_redacted_v1"), "redacted": redacted & ~of("redacted", "boolean").eqNullSafe(F.lit(True)), "redacted_content": redacted & content,
    }
    return check(items, "projection", key, rules)


def errors(rows: DataFrame, known: DataFrame, key: str = "source") -> DataFrame:
    """Rules of the error archive: a known source, an address without query and fragment, a safe error, a time."""
    s = rows.join(known.select(F.col("source").alias("known")).distinct(), F.col("source") == F.col("known"), "left")
    return check(s, "errors", key, {"unknown_source": F.col("known").isNull(), "url": ~F.coalesce(T.public_url(F.col("url")), F.lit(False)), "url_query": T.public_url(F.col("url")) & F.col("url").rlike("[?#]."), "error": ~F.coalesce(F.col("error").rlike(SAFE_ERROR), F.lit(False)), "collected": F.col("collected").isNull()})


def violations(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def collisions(rows: DataFrame, virtual: DataFrame) -> DataFrame:
    """Generated ids that a source of the registry has, too."""
    both = virtual.join(rows.select(F.col("source").alias("known")).distinct(), F.col("source") == F.col("known"))
    return both.select(F.lit("registry").alias("scope"), F.col("source").alias("key"), F.lit("generated_id").alias("rule"))


# Keys of the settings document by what they must hold.
POSITIVE = ("poll_seconds", "workers", "request_timeout_seconds", "default_lookback_hours", "telegram_max_pages", "x_max_pages", "web_max_links", "public_excerpt_chars", "public_media_limit")
NOT_NEGATIVE = ("collection_delay_hours", "site_publication_delay_hours", "site_sensitive_delay_hours")
DELAYS = ("collection_delay_by_group", "collection_delay_by_tag", "collection_delay_by_source")
PATHS = ("raw_root", "error_root", "state_file", "report_root", "site_root")
LISTS = ("sensitive_tags", "public_redact_tags", "x_search_queries")
DOMAIN = r"(?=.{1,253}$)(?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.)+[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?"


def _number(value) -> float | None:
    try:
        return None if isinstance(value, bool) else float(value)
    except (TypeError, ValueError):
        return None


def _whole(value) -> int | None:
    try:
        return None if isinstance(value, bool) or (isinstance(value, float) and value % 1) else int(value)
    except (TypeError, ValueError):
        return None


def settings(s: dict, whole: bool = False) -> list[str]:
    """Rules that a settings document breaks; it is one small document, so this is plain Python. whole: keys that are
    missing break their rules, too."""
    bad: list[str] = []
    there = lambda keys: [k for k in keys if whole or k in s]

    def rule(ok: bool, text: str) -> None:
        if not ok:
            bad.append(text)

    must = ("poll_seconds", "workers", "public_excerpt_chars", "public_media_limit")
    for k in POSITIVE if whole else [*must, *(x for x in there(POSITIVE) if x not in must)]:
        rule((_whole(s.get(k)) or 0) >= 1, f"{k}: not a positive whole number")
    for k in there(NOT_NEGATIVE):
        n = _number(s.get(k))
        rule(n is not None and n >= 0, f"{k}: negative or not a number")
    if s.get("status_stale_after_hours") is not None:
        rule((_number(s["status_stale_after_hours"]) or 0) > 0, "status_stale_after_hours: not a positive number")
    for k in there(DELAYS):
        if not isinstance(s.get(k), dict):
            bad.append(f"{k}: not an object")
            continue
        for name, value in s[k].items():
            n = _number(value)
            rule(n is not None and n >= 0, f"{k}.{name}: negative or not a number")
    for k in PATHS if whole else ("raw_root", "report_root", "site_root", *(x for x in ("error_root", "state_file") if x in s)):
        rule(isinstance(s.get(k), str) and T.safe_relative(s[k]), f"{k}: unsafe path")
    try:
        ZoneInfo(s.get("report_timezone", ""))
    except Exception:  # noqa: BLE001  any unknown or malformed name
        bad.append("report_timezone: unknown")
    for k in there(LISTS):
        rule(isinstance(s.get(k), list), f"{k}: not an array")
    for n, q in enumerate(s["x_search_queries"] if isinstance(s.get("x_search_queries"), list) else []):
        rule(isinstance(q, str) and bool(q.strip()), f"x_search_queries[{n}]: blank or no text")
    redact, sensitive = s.get("public_redact_tags") or [], s.get("sensitive_tags") or []
    if isinstance(redact, list) and isinstance(sensitive, list):
        rule(set(map(str, redact)) <= set(map(str, sensitive)), "public_redact_tags: not among sensitive_tags")
    for k in there(("platform_cadence_minutes", "minimum_group_counts")):
        if not isinstance(s.get(k), dict):
            bad.append(f"{k}: not an object")
            continue
        for name, value in s[k].items():
            n = _whole(value)
            rule(k != "platform_cadence_minutes" or name in PLATFORMS, f"{k}.{name}: unknown platform")
            rule(n is not None and (n >= 1 or k != "platform_cadence_minutes"), f"{k}.{name}: not a whole number" if n is None else f"{k}.{name}: less than 1")
    allowed = s.get("article_host_allowlist")
    if allowed is not None and not isinstance(allowed, dict):
        bad.append("article_host_allowlist: not an object")
        allowed = None
    for source, hosts in (allowed or {}).items():
        ok = isinstance(hosts, list) and bool(hosts) and all(isinstance(h, str) and re.fullmatch(DOMAIN, h) for h in hosts)
        rule(ok and bool(source), f"article_host_allowlist: {source}")
    return bad
