"""Lookups, anti joins, upserts and differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def drop_seen(items: DataFrame, archive_ids: DataFrame, key: str = "item_id") -> DataFrame:
    """Items that the archive doesn't hold; AQE broadcasts the ids while they are few."""
    return items.join(archive_ids, key, "left_anti")


def missing_keys(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose key the dimension lacks (nulls too): foreign keys, orphans, unknown ids."""
    return facts.join(dimension.select(key).distinct(), key, "left_anti")


def upsert(previous: DataFrame, updates: DataFrame, key: str, durable: list[str]) -> DataFrame:
    """State after updates: durable columns keep their last known value, others are as the update says."""
    p, u = previous.alias("p"), updates.alias("u")
    j = p.join(u, F.col(f"p.{key}") == F.col(f"u.{key}"), "full_outer")
    touched = F.col(f"u.{key}").isNotNull()
    cols = [F.coalesce(f"u.{key}", f"p.{key}").alias(key)]
    for c in previous.columns:
        if c != key:
            cols.append((F.coalesce(f"u.{c}", f"p.{c}") if c in durable else F.when(touched, F.col(f"u.{c}")).otherwise(F.col(f"p.{c}"))).alias(c))
    return j.select(*cols)


def reattribute(items: DataFrame, registry: DataFrame, handle: str) -> DataFrame:
    """Items found by search go to the registered source with the same handle, case aside."""
    r = registry.select(F.lower(handle).alias("h"), F.col("source").alias("r_source"))
    return items.join(r, F.lower(items["handle"]) == r["h"], "left").withColumn("owner", F.coalesce("r_source", "source")).drop("h", "r_source")


def with_media(posts: DataFrame, media: DataFrame) -> DataFrame:
    """Posts with the addresses of their media keys, in the order of the keys."""
    keys = posts.select("post_id", F.posexplode_outer("media_keys").alias("pos", "media_key"))
    found = keys.join(media, "media_key", "left").where("url is not null")
    urls = found.groupBy("post_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "url"))), lambda x: x["url"]).alias("media"))
    return posts.join(urls, "post_id", "left").withColumn("media", F.coalesce("media", F.array().cast("array<string>")))


def difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """path, problem of two (path, bytes, digest) listings."""
    j = expected.alias("e").join(actual.alias("a"), F.col("e.path") == F.col("a.path"), "full_outer")
    problem = (F.when(F.col("a.path").isNull(), "missing").when(F.col("e.path").isNull(), "unexpected").when(F.col("e.bytes") != F.col("a.bytes"), "size").when(F.col("e.digest") != F.col("a.digest"), "digest"))
    return j.select(F.coalesce("e.path", "a.path").alias("path"), problem.alias("problem")).where("problem is not null")


def merged_days(reports: DataFrame, summaries: DataFrame) -> DataFrame:
    """Every day of either listing with what exists and the days before and after it."""
    j = reports.withColumn("r", F.lit(True)).join(summaries.withColumn("s", F.lit(True)), "day", "full_outer")
    w = Window.orderBy("day")  # a row per day of the archive
    return j.select("day", F.coalesce("r", F.lit(False)).alias("has_report"), F.coalesce("s", F.lit(False)).alias("has_summary"), F.lag("day").over(w).alias("older"), F.lead("day").over(w).alias("newer"))
