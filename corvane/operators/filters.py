"""Selection, timeliness and policy predicates. Every operator maps DataFrames to DataFrames; `now` is a parameter."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import text as T


def utc_range(day: date, zone: str) -> tuple[date, date]:
    """The inclusive range of UTC days that a local day touches."""
    z = ZoneInfo(zone)
    lo = datetime(day.year, day.month, day.day, tzinfo=z)
    nxt = day + timedelta(days=1)
    hi = datetime(nxt.year, nxt.month, nxt.day, tzinfo=z)
    utc = ZoneInfo("UTC")
    return lo.astimezone(utc).date(), hi.astimezone(utc).date()


def local_day(items: DataFrame, day: date, zone: str, event: str = "event_ts", utc_day: str = "utc_day") -> DataFrame:
    """Items of a local day; the range of UTC days beside it lets partitions be pruned, which the local predicate can't."""
    lo, hi = utc_range(day, zone)
    return items.where(F.col(utc_day).between(F.lit(lo), F.lit(hi))).where(F.to_date(F.from_utc_timestamp(event, zone)) == F.lit(day))


def local_days(items: DataFrame, first: date, last: date, zone: str, event: str = "event_ts", utc_day: str = "utc_day") -> DataFrame:
    """One scan for a range of local days."""
    lo, hi = utc_range(first, zone)[0], utc_range(last, zone)[1]
    return items.where(F.col(utc_day).between(F.lit(lo), F.lit(hi))).where(F.to_date(F.from_utc_timestamp(event, zone)).between(F.lit(first), F.lit(last)))


def select_sources(registry: DataFrame, groups: list[str] | None = None, platforms: list[str] | None = None, ids: list[str] | None = None) -> DataFrame:
    out = registry.where("enabled")
    for col, values in (("grp", groups), ("platform", platforms), ("source", ids)):
        if values is not None:
            out = out.where(F.col(col).isin(values))
    return out


def unknown_ids(registry: DataFrame, ids: list[str]) -> DataFrame:
    asked = registry.sparkSession.sql(f"SELECT explode(array({', '.join(repr(i) for i in ids)})) AS source") if ids else registry.select("source").limit(0)
    return asked.join(registry, "source", "left_anti")


def cadence_minutes(cadence: Column, platform: Column, table: dict[str, int], poll_seconds: int) -> Column:
    by_platform = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.greatest(F.lit(1), F.coalesce(cadence.cast("int"), F.try_element_at(by_platform, platform), F.lit(poll_seconds // 60)))


def is_due(now: Column, last_success: Column, minutes: Column, force: bool = False) -> Column:
    return F.lit(force) | last_success.isNull() | (now >= last_success + F.make_dt_interval(mins=minutes))


def within_lookback(published: Column, since: Column) -> Column:
    return published.isNull() | (published >= since)


def embargo_state(published: Column, now: Column, delay_hours: Column) -> Column:
    seconds = F.unix_micros(now) - F.unix_micros(published)
    return (F.when(delay_hours <= 0, "storable").when(published.isNull(), "withheld_undated").when(seconds < delay_hours * 3_600_000_000, "withheld_recent").otherwise("storable"))


def tagged(tags: Column, wanted: list[str]) -> Column:
    return F.coalesce(F.arrays_overlap(tags, F.array(*[F.lit(t) for t in wanted])), F.lit(False))


def card_search(items: DataFrame, needle: str = "", platform: str = "", group: str = "") -> DataFrame:
    """Substring of the lower-cased search text, and equality on platform and group where given."""
    text = F.lower(F.concat_ws(" ", "title", "source_name", "platform", "grp"))
    out = items.where(F.contains(text, F.lit(needle.lower())))
    if platform:
        out = out.where(F.col("platform") == platform)
    return out.where(F.col("grp") == group) if group else out


def publisher_domains(host: Column, extra: Column) -> Column:
    """Domains that a source may fetch from: its host, the parent of a www-like host, and configured ones that look like hosts."""
    labels = F.split(host, r"\.")
    parent = F.when((F.size(labels) >= 3) & F.element_at(labels, 1).isin("www", "rss", "feed", "feeds", "api"), F.array_join(F.slice(labels, F.lit(2), F.size(labels)), "."))
    valid = F.filter(F.coalesce(extra, F.array().cast("array<string>")), lambda d: d.rlike(r"^[a-z0-9-]+(\.[a-z0-9-]+)+$"))
    return F.array_distinct(F.array_compact(F.concat(F.array(host, parent), valid)))


def publisher_allowed(url: Column, domains: Column) -> Column:
    h = T.host(url)
    return url.startswith("https://") & ~url.rlike("^https://[^/?#]*@") & F.exists(domains, lambda d: (h == d) | h.endswith(F.concat(F.lit("."), d)))


def lacks_credential(platform: Column, needs: list[str], configured: list[str]) -> Column:
    """Whether a source's platform asks for a credential that isn't configured."""
    return platform.isin(*[p for p in needs if p not in configured]) if set(needs) - set(configured) else F.lit(False)


# Where the files of an artifact lie, and what else a checkout may hold beside them.
ARTIFACT_ROOTS = {"raw_root": "data/raw", "error_root": "data/errors", "state_file": "data/state.json", "report_root": "reports/daily"}
NOT_OF_AN_ARTIFACT = ("reports/summary", "reports/weekly")


def safe_path(path: Column) -> Column:
    """A relative path that stays below its root, without empty and dot parts; null for others."""
    parts = F.filter(F.split(path, "/"), lambda p: ~p.isin("", "."))
    return F.when(~path.rlike(r"^/|\\") & (F.size(parts) > 0) & ~F.array_contains(parts, ".."), F.array_join(parts, "/"))


def artifact_allowed(path: Column, roots: dict[str, str] | None = None) -> Column:
    """Paths of an artifact: the state file, items and errors by day below their roots, and daily reports."""
    r = ARTIFACT_ROOTS | (roots or {})
    day = r"[0-9]{4}/[0-9]{2}/[0-9]{2}"
    kinds = [rf"{re.escape(r['raw_root'])}/{day}/items\.ndjson", rf"{re.escape(r['error_root'])}/{day}/errors\.ndjson", rf"{re.escape(r['report_root'])}/[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}\.md"]
    p = safe_path(path)
    return F.coalesce((p == r["state_file"]) | p.rlike(rf"^({'|'.join(kinds)})\z"), F.lit(False))


def artifact_ignored(path: Column, prefixes: tuple[str, ...] = NOT_OF_AN_ARTIFACT) -> Column:
    """Files that belong to the repository, not to an artifact."""
    p, below = safe_path(path), F.lit(False)
    for prefix in prefixes:
        below = below | (p == prefix) | p.startswith(prefix + "/")
    return F.coalesce(below, F.lit(False))


def recovery_days(reports: DataFrame, archive_days: DataFrame, today: date, back: int = 7) -> DataFrame:
    """Yesterday and today, and earlier days within ``back`` that have raw data but no report."""
    spark = archive_days.sparkSession
    days = spark.range(0, back + 1).select(F.date_sub(F.lit(today), F.col("id").cast("int")).alias("day"), (F.col("id") <= 1).alias("always"))
    missing = days.where("not always").join(reports, "day", "left_anti").join(archive_days, "day", "left_semi")
    return days.where("always").unionByName(missing).select("day")
