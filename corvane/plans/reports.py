"""Report tables and their thin renderings: status document, daily digest, weekly lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.operators import aggregates as A
from corvane.operators import filters as S


def status_tables(registry: DataFrame, state: DataFrame, items: DataFrame, now: Column, poll_seconds: int, delay_hours: float = 24.0) -> DataFrame:
    """section, key, n: the public status as a table - the run, the registry, sources by status, platform and group,
    what is degraded, what is withheld, and how fresh it is."""
    enabled = registry.where("enabled")
    j = enabled.join(state.select("source", "status", "last_success"), "source", "left").withColumn("status", F.coalesce("status", F.lit("unknown")))
    long = lambda df, section: df.select(F.lit(section).alias("section"), "key", F.col("n").cast("long").alias("n"))
    flat = lambda df, names, section: long(df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(c).cast("long").alias("n")) for k, c in names.items()])).alias("x")).select("x.*"), section)
    by = lambda c, section: long(j.select(c, F.explode(F.array(F.lit("configured"), "status")).alias("s")).groupBy(F.concat_ws(".", c, "s").alias("key")).agg(F.count(F.lit(1)).alias("n")), section)
    run = A.run_rollup(state, enabled)
    held = items.select(S.embargo_state(F.col("published"), now, F.lit(delay_hours)).alias("state")).agg(F.count_if(F.col("state") == "withheld_recent").alias("recent"), F.count_if(F.col("state") == "withheld_undated").alias("undated"))
    limit = max(1.0, poll_seconds * 4 / 3600)
    fresh = state.agg(F.max("checked").alias("run")).select(F.coalesce((F.unix_micros(now) - F.unix_micros("run")) / 3.6e9 > limit, F.lit(True)).cast("long").alias("stale"))
    parts = [
        flat(run, {k: k for k in ("attempted", "succeeded", "skipped", "errors", "added")}, "run"), flat(enabled.agg(F.count(F.lit(1)).alias("n")), {"configured_total": "n"}, "registry"),
        flat(state.join(enabled.select("source"), "source", "left_anti").agg(F.count(F.lit(1)).alias("n")), {"orphaned_state_sources": "n"}, "registry"),
        long(A.status_totals(registry, state).withColumnRenamed("status", "key"), "source_status_counts"), by("platform", "by_platform"), by("grp", "by_group"),
        flat(A.degradation(registry, state), {k: k for k in ("source_errors", "configuration_skips", "unknown_sources")}, "degradation"), flat(held, {"recent": "recent", "undated": "undated"}, "withholding"),
        flat(j.agg(F.unix_timestamp(F.max("last_success")).alias("n")), {"latest_source_success_s": "n"}, "freshness"), flat(fresh, {"stale": "stale"}, "freshness"),
    ]
    return reduce(DataFrame.unionByName, parts)


def status_document(tables: DataFrame, generated: str) -> DataFrame:
    """One row, document: the status tables as JSON, a map of keys for each section."""
    sections = tables.groupBy("section").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "n")))).alias("of"))
    whole = sections.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("section", "of")))).alias("status"))
    return whole.select(F.to_json(F.struct(F.lit(generated).alias("generated_at"), F.lit("current-state-only").alias("scope"), "status")).alias("document"))


def weekly_counts(items: DataFrame, section: Column, first: str, last: str) -> DataFrame:
    """dimension, value, n of a week's items: sources, platforms, groups, sections and days, days without items too."""
    week = items.where(F.col("local_day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).withColumn("section", section)
    counts = A.coverage_sets(week, ["source", "platform", "grp", "section"])
    days = A.zero_filled(week, "local_day", first, last).select(F.lit("local_day").alias("dimension"), F.col("day").cast("string").alias("value"), "n")
    return counts.unionByName(days)


def digest_lines(items: DataFrame, section: str = "section", most: int = 8, chars: int = 240) -> DataFrame:
    """section, place, line: markdown lines of the first items of each section."""
    w = Window.partitionBy(section).orderBy(F.col("stamp").desc(), F.char_length("text"), "item_id")
    cut = F.rtrim(F.substring(T.clean(F.col("text")), 1, chars))
    short = F.when(F.char_length(T.clean(F.col("text"))) > chars, F.concat(cut, F.lit("…"))).otherwise(cut)
    line = F.concat(F.lit("- **"), T.markdown(F.col("source_name")), F.lit("** "), T.markdown(short))
    return items.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most).select(section, "place", line.alias("line"))


def render(title: str, lines: DataFrame) -> str:
    """A markdown text of a bounded report table."""
    out, last = [f"# {title}", ""], None
    for r in lines.orderBy(*lines.columns[:2]).collect():
        if r[0] != last:
            out += ["", f"## {r[0]}", ""]
            last = r[0]
        out.append(r["line"])
    return "\n".join(out) + "\n"
