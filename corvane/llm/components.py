"""Connected components of a link table, by Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_tables, settle, small


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (a, b: long, a > b) that isn't the smallest of its component.

    Each round links every node to its smallest neighbour below, and its other neighbours to that one, until each node
    has one link down; then links are followed two at a time. Links are aggregated before they are dealt out, tables are
    written between rounds, and nothing is gathered but counts.
    """
    e = settle(links.distinct(), "cc-links")
    while True:
        least = e.groupBy("a").agg(F.min("b").alias("p"), F.count(F.lit(1)).alias("n"))
        if not least.where("n > 1").limit(1).count():
            break
        rest = e.join(least.where("n > 1"), "a").where("b <> p").select(F.greatest("b", "p").alias("a"), F.least("b", "p").alias("b"))
        old, e = e, settle(least.select("a", F.col("p").alias("b")).unionByName(rest).distinct(), "cc-links")
        drop_tables(e.sparkSession, old)
    while True:
        up = e.select(F.col("a").alias("b"), F.col("b").alias("top"))
        nxt = settle(e.join(small(up), "b", "left").select("a", F.coalesce("top", "b").alias("b"), F.col("top").isNotNull().alias("moved")), "cc-roots")
        moved = nxt.where("moved").limit(1).count()
        old, e = e, nxt.drop("moved")
        drop_tables(e.sparkSession, old)
        if not moved:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
