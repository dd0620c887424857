"""Mixing sources to target weights by entropy balancing, rounded into copies.

Every document gets the rate that is nearest in entropy to 1 (one copy) while the tokens of each source meet their
target and no rate exceeds the cap. The dual of that convex problem has one multiplier per source, and its solution
is an exponential tilt, rate = min(cap, exp(lambda_source * size / mean size of the source)). All that a dual needs to
know of the documents is its source's histogram of sizes, which is one distributed aggregation, in bins so that it is
bounded (sizes from 4096 on share a bin with those that differ by less than 1 in 4096, which counts at its mean size).
Newton's method, kept inside a bracket, then runs for all sources side by side as a fold over that histogram, in one job.
Rates become copies by systematic rounding along documents sorted by size, and a last pass moves single copies where a
source is still off its target. DataFrame functions only.

Defined cases: null or empty text has size 0 and takes 0 words; a null source is a source of its own, sorted last;
repeated rows are mixed row by row; an empty table gives an empty table; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_partitions, settle, small, word_count

#: Rates are summed as whole numbers of this fraction of a copy, so that sums don't depend on their order.
ONE = 1 << 24


def source_targets(hist: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """source, source_size, target of a (source, size, n) histogram.

    Sources by code point (null last) weigh ``weights``, repeating, and share the total size; a target stops at
    ``cap`` times its source's size and the excess is shared anew. With sources sorted by how early they stop, the
    common level is where the rest of the total over the rest of the weights stops no further source. The windows
    without a key run over one row per source, not over documents.
    """
    s = hist.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    w = F.array(*[F.lit(float(x)) for x in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = s.withColumn("w", F.element_at(w, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("stop", cap * F.col("source_size")).withColumn("rho", F.col("stop") / F.col("w"))
    order = Window.orderBy("rho", F.col("source").asc_nulls_last())
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("level", (F.sum("source_size").over(every) - before) / rest)
    s = s.withColumn("level", F.min(F.when(F.col("level") <= F.col("rho"), F.struct("rho", "level"))).over(every)["level"])
    return s.select("source", "source_size", F.coalesce(F.least("stop", F.col("w") * F.col("level")), "stop").alias("target"))


def let(value: Column, f) -> Column:
    """f(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def binned(hist: DataFrame) -> DataFrame:
    """source, bins (x: mean size of a bin over that of the source; tok: its tokens; by rising size), mean of sources with tokens."""
    octave = F.greatest(F.floor(F.log2("size")).cast("int") - 12, F.lit(0))
    b = hist.where("size > 0").groupBy("source", F.call_function("shiftright", F.col("size"), octave).alias("b"), octave.alias("o")).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("tok"))
    g = b.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("o", "b", "n", "tok"))).alias("xs"), (F.sum("tok") / F.sum("n")).alias("mean"))  # at most 4096 bins an octave
    return g.select("source", "mean", F.transform("xs", lambda e: F.struct((e["tok"] / e["n"] / F.col("mean")).alias("x"), e["tok"].cast("double").alias("tok"))).alias("bins"))


def solve_duals(hist: DataFrame, targets: DataFrame, cap: float = 3.0, rounds: int = 60, tol: float = 1e-9) -> DataFrame:
    """source, source_size, target, mean, lam (null: every rate is the cap) by bracketed Newton iterations."""
    b = binned(hist).withColumnRenamed("source", "b_source")
    full = F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)
    state = targets.join(b, targets["source"].eqNullSafe(b["b_source"]), "left").drop("b_source")

    def sums(lam: Column) -> Column:
        def add(a: Column, e: Column) -> Column:
            return let(F.exp(F.least(lam * e["x"], F.lit(700.0))), lambda raw: F.struct(
                (a["f"] + e["tok"] * F.least(raw, F.lit(cap))).alias("f"), (a["d"] + F.when(raw < cap, e["tok"] * e["x"] * raw).otherwise(0.0)).alias("d")))

        return F.aggregate("bins", F.struct(F.lit(0.0).alias("f"), F.lit(0.0).alias("d")), add)

    def newton(s: Column, _: Column) -> Column:
        def move(v: Column) -> Column:
            g = v["f"] - F.col("target")
            hi, lo = F.when(g > 0, s["lam"]).otherwise(s["hi"]), F.when(g < 0, s["lam"]).otherwise(s["lo"])
            step = F.round(F.when(v["d"] > 0, s["lam"] - g / v["d"]), 13)
            inside = F.coalesce((lo.isNull() | (step > lo)) & (hi.isNull() | (step < hi)) & (F.abs(step - s["lam"]) < 50), F.lit(False))
            fall = F.when(lo.isNotNull() & hi.isNotNull(), (lo + hi) / 2).when(hi.isNotNull(), hi * 2 - 1).otherwise(F.coalesce(lo, F.lit(0.0)) * 2 + 1)
            done = F.abs(g) <= tol * F.greatest(F.col("target"), F.lit(1.0))
            return F.struct(F.when(done, s["lam"]).when(inside, step).otherwise(fall).alias("lam"), lo.alias("lo"), hi.alias("hi"), done.alias("done"))

        return F.when(s["done"], s).otherwise(let(sums(s["lam"]), move))

    none = F.lit(None).cast("double")
    start = F.struct(F.lit(0.0).alias("lam"), none.alias("lo"), none.alias("hi"), F.col("bins").isNull().alias("done"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, newton)["lam"]
    return state.select("source", "source_size", "target", "mean", F.when(~full, found).alias("lam"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (5, 2, 1), cap: int = 3, repairs: int = 3) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken (= copies * size).

    Copies are floor or ceiling of the rate. Within a source, sorted by falling size, running sums of copies stay within
    half a copy of the running sums of rates, so the error in tokens is at most half the largest document; each of
    ``repairs`` passes then changes the one document per source whose size is nearest to what is still missing.
    Running sums come from range partitions of equal length, so a source with a third of the rows is split like any other.
    """
    return _mix(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), F.lit(0).cast("long").alias("row")), weights, cap, repairs).drop("row")


def _mix(sizes: DataFrame, weights: tuple[float, ...], cap: int, repairs: int) -> DataFrame:
    """mix of rows (doc_id, source, size, row); row tells rows with one id and size apart."""
    spark = sizes.sparkSession
    sizes = settle(sizes, "mix-sizes")
    hist = settle(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-hist")
    state = settle(solve_duals(hist, source_targets(hist, weights, cap), cap), "mix-state")
    st = small(state.select(F.col("source").alias("s_source"), "source_size", "target", "mean", "lam"))
    rate = F.when(F.col("lam").isNull(), F.lit(float(cap))).otherwise(
        F.least(F.lit(float(cap)), F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(700.0)))))
    rate = F.when((F.col("size") == 0), F.lit(1.0)).otherwise(rate)
    rated = (sizes.join(st, F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source").withColumn("rate", rate)
             .withColumn("units", F.round(F.col("rate") * ONE).cast("long")))
    ranged = rated.repartitionByRange(n_partitions(spark), F.col("source"), F.col("size").desc(), F.col("doc_id"), F.col("row"))
    ranged = settle(ranged.withColumn("pid", F.spark_partition_id()), "mix-ranged")
    parts = ranged.groupBy("source", "pid").agg(F.sum("units").alias("part"))
    ahead = Window.partitionBy("source").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("source").alias("p_source"), F.col("pid").alias("p_pid"), F.coalesce(F.sum("part").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("source", "pid").orderBy(F.col("size").desc(), "doc_id", "row").rowsBetween(Window.unboundedPreceding, 0)
    run = ranged.join(small(parts), F.col("source").eqNullSafe(F.col("p_source")) & (F.col("pid") == F.col("p_pid"))).withColumn("upto", F.col("ahead") + F.sum("units").over(within))
    run = run.withColumn("copies", (F.shiftright(F.col("upto") + ONE // 2, 24) - F.shiftright(F.col("upto") - F.col("units") + ONE // 2, 24)))
    run = settle(run.select("row", "doc_id", "source", "size", "source_size", "target", "rate", "copies", "units", "upto"), "mix-copies")
    for _ in range(repairs):
        miss = small(run.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("miss")).withColumnRenamed("source", "m_source"))
        near = run.where("size > 0 and units > 0").join(miss, F.col("source").eqNullSafe(F.col("m_source")))
        fits = F.when(F.col("miss") > 0, F.col("copies") < cap).otherwise(F.col("copies") > 0) & (F.abs(F.abs("miss") - F.col("size")) < F.abs("miss"))
        pick = (near.where(fits).groupBy("m_source").agg(F.min(F.struct(F.abs(F.abs("miss") - F.col("size")).alias("off"), F.col("upto"), F.signum("miss").cast("long").alias("step"))).alias("p"))
                .select("m_source", F.col("p.upto").alias("m_upto"), F.col("p.step").alias("step")))
        run = run.join(small(pick), F.col("source").eqNullSafe(F.col("m_source")) & (F.col("upto") == F.col("m_upto")) & (F.col("units") > 0) & (F.col("size") > 0), "left")
        run = run.withColumn("copies", F.col("copies") + F.coalesce("step", F.lit(0))).drop("m_source", "m_upto", "step")
    return run.select("row", "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), cap: int = 3, repairs: int = 3) -> DataFrame:
    """docs, all columns, each row as often as the mix takes it; rows with one id are mixed each by itself."""
    of = "_mix_row"
    while of in docs.columns:
        of += "_"
    rows = settle(docs.withColumn(of, F.monotonically_increasing_id()), "mix-rows")
    taken = _mix(rows.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), F.col(of).alias("row")), weights, cap, repairs)
    copies = taken.where("copies > 0").select(F.col("row").alias(of), F.array_repeat(F.lit(1), F.col("copies").cast("int")).alias(of + "n"))
    return rows.join(copies, of).withColumn(of + "c", F.explode(of + "n")).select(*docs.columns)
