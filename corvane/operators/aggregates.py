"""Counts, roll-ups, health and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.session import settled

STATUSES = ["ok", "error", "skipped_config", "skipped_cadence", "unknown"]


def last_wins(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """One row per key: the values of its last occurrence at the place of its first. Partial aggregation, no window."""
    rest = [c for c in rows.columns if c != key]
    g = rows.groupBy(key).agg(F.max_by(F.struct(*rest), seq).alias("v"), F.min(seq).alias("first_seq"))
    return g.select(key, *[F.col(f"v.{c}").alias(c) for c in rest], "first_seq")


def counts(items: DataFrame, key: str, default: str) -> DataFrame:
    return items.groupBy(F.coalesce(F.when(F.col(key) != "", F.col(key)), F.lit(default)).alias(key)).agg(F.count(F.lit(1)).alias("n"))


def coverage_sets(items: DataFrame, keys: list[str]) -> DataFrame:
    """dimension, value, n for several keys in one pass of grouping sets."""
    sets = ", ".join(f"({k})" for k in keys)
    which = "CASE " + " ".join(f"WHEN grouping({k}) = 0 THEN '{k}'" for k in keys) + " END"
    value = "coalesce(" + ", ".join(f"cast({k} as string)" for k in keys) + ")"
    return items.sparkSession.sql(f"SELECT {which} AS dimension, {value} AS value, count(*) AS n FROM {{t}} GROUP BY GROUPING SETS ({sets})", t=items.select(*keys))


def zero_filled(items: DataFrame, day: str, first: str, last: str) -> DataFrame:
    spark = items.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    n = items.groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(n, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


def status_pivot(registry: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """Configured sources and their statuses by a registry column; sources without state are unknown."""
    j = registry.where("enabled").join(state.select("source", "status"), "source", "left")
    status = F.coalesce("status", F.lit("unknown"))
    return j.groupBy(key).agg(F.count(F.lit(1)).alias("configured"), *[F.count_if(status == s).alias(s) for s in STATUSES])


def status_totals(registry: DataFrame, state: DataFrame) -> DataFrame:
    """Every status, those without sources too."""
    spark = registry.sparkSession
    names = spark.range(1).select(F.explode(F.array(*[F.lit(s) for s in STATUSES])).alias("status"))
    j = registry.where("enabled").join(state.select("source", "status"), "source", "left")
    n = j.groupBy(F.coalesce("status", F.lit("unknown")).alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return names.join(n, "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n"))


def run_status(attempted: Column, errors: Column, succeeded: Column, blocked: Column, selected_open: Column) -> Column:
    """failed, blocked, partial, idle or ok, in that order. selected_open: selected sources that need no credential."""
    return (F.when((attempted > 0) & (succeeded == 0), "failed").when((attempted == 0) & (blocked > 0) & (selected_open == 0), "blocked")
            .when((errors > 0) | (blocked > 0), "partial").when(attempted == 0, "idle").otherwise("ok"))


def run_rollup(state: DataFrame, selected: DataFrame, withheld: DataFrame | None = None, credential: str = "x") -> DataFrame:
    """One row: counts and status of a run over the selected sources (platform); withheld: items' states, where known."""
    s = F.col("status")
    r = state.agg(F.count(F.lit(1)).alias("configured"), F.count_if(s.isin("ok", "error")).alias("attempted"), F.count_if(s == "ok").alias("succeeded"), F.count_if(s.startswith("skipped")).alias("skipped"), F.count_if(s == "skipped_config").alias("blocked"), F.count_if(s == "error").alias("errors"), F.sum("added").alias("added"), F.sum("fetched").alias("fetched"))
    r = r.crossJoin(selected.agg(F.count_if(F.coalesce(F.col("platform"), F.lit("")) != credential).alias("selected_open")))  # one row each
    if withheld is not None:
        states = F.col("state")
        r = r.crossJoin(withheld.agg(F.count_if(states == "withheld_recent").alias("withheld_recent"), F.count_if(states == "withheld_undated").alias("withheld_undated")))
    return r.withColumn("run_status", run_status(F.col("attempted"), F.col("errors"), F.col("succeeded"), F.col("blocked"), F.col("selected_open"))).drop("selected_open")


def health(registry: DataFrame, state: DataFrame, now: Column, threshold_hours: float) -> DataFrame:
    """source, classification by the ladder; state rows of unknown sources are orphans."""
    j = registry.select("source", "enabled").join(state, "source", "full_outer")
    age = (F.unix_micros(now) - F.unix_micros("last_success")) / 3.6e9
    kind = (F.when(F.col("enabled").isNull(), "orphan_state").when(~F.col("enabled"), "disabled").when(F.col("status").isNull(), "never_seen").when(F.col("status") == "error", "current_error")
            .when(F.col("status") == "skipped_config", "configuration_blocked").when(F.col("last_success").isNull(), "never_succeeded").when(age > threshold_hours, "stale_success")
            .when(F.col("status") == "skipped_cadence", "cadence_wait").when(F.col("status") == "ok", "healthy").otherwise("unknown_state"))
    return j.select("source", kind.alias("classification"))


def degradation(registry: DataFrame, state: DataFrame) -> DataFrame:
    """One row: enabled sources with an error, without their configuration, and without a state."""
    j = registry.where("enabled").join(state.select("source", "status"), "source", "left")
    return j.agg(F.count_if(F.col("status") == "error").alias("source_errors"), F.count_if(F.col("status") == "skipped_config").alias("configuration_skips"), F.count_if(F.col("status").isNull()).alias("unknown_sources"))


def placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows with their place (from 1) in an order: ranges are sorted each, and numbered on from those before them."""
    ranged = settled(rows.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order).withColumn("_part", F.spark_partition_id()), "placed")
    n = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = n.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")  # a row per range
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.join(F.broadcast(before), "_part").withColumn("place", F.col("_before") + within).drop("_part", "_before")


def health_result(run: DataFrame, now: Column, stale_hours: float) -> DataFrame:
    """healthy, and sorted reasons, of rows (run_status, last_run, source_errors, configuration_skips, unknown_sources).

    Only the run's status and its age decide whether it is healthy; degraded sources are reasons without being failures.
    A run that never was is stale."""
    stale = F.coalesce((F.unix_micros(now) - F.unix_micros("last_run")) / 3.6e9 > stale_hours, F.lit(True))
    bad = ~F.col("run_status").isin("ok", "idle")
    some = [F.when(F.col(c) > 0, F.lit(c)) for c in ("source_errors", "configuration_skips", "unknown_sources")]
    reasons = F.array_sort(F.array_compact(F.array(F.when(bad, F.concat(F.lit("run_"), "run_status")), F.when(stale, F.lit("state_stale")), *some)))
    return run.select("*", (~bad & ~stale).alias("healthy"), F.array_join(reasons, ",").alias("reasons"))
