"""Connected components of a link table, as Spark jobs.

Alternating large-star and small-star steps: every node is re-linked to the
least node it knows of, until each component is one star around its least id.
Each step is a group-by for the minimum (summed map-side, so a hot node costs
one row per task) and a join that Spark may split when a node is skewed.  The
links never reach the driver; only their count and a checksum per round do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written

MAX_ROUNDS = 60  # a safety stop that raises; a round at least halves the depth of long chains in practice


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    near = _both_ways(links)
    least = near.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.col("u")).alias("m"))
    joined = near.join(least, near["a"] == least["u"]).where("b > a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    joined = down.join(least, down["a"] == least["u"])
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the least node reachable, for every node of ``links`` (columns ``a, b``) but the least ones.

    A node that is its own component's least id has no row.  Null ends and
    self-links are ignored.
    """
    now = written(links.where("a IS NOT NULL AND b IS NOT NULL AND a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (state["n"], state["h"]) == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = (state["n"], state["h"])
        now = written(_small_star(_large_star(now)), "links")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
