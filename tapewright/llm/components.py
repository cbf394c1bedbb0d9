"""Connected components of a table of links, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapewright.llm.common import written


def _smallest(ends: DataFrame) -> DataFrame:
    """Every end with the smallest node next to it, itself included.

    The minimum is combined inside the map tasks; joining it back is left to
    Spark, which splits a node that holds many links.
    """
    least = ends.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return ends.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    ends = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _smallest(ends).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links run from the larger node ``u`` to the smaller ``v``."""
    met = _smallest(links)
    over = met.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return over.union(met.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node with a link; the root is the smallest node of its component.

    Alternating star steps: links of a node move to its smallest neighbour
    until every component is one star.  Each round is written to the shared
    folder, so a lost executor costs one round at most, and the driver sees a
    count and a sum per round.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = written(links.select(u, v).filter("u != v").distinct(), "links")
    before, state = None, _state(now)
    while state[0] and state != before:
        before = state
        now = written(_small_star(_large_star(now)), "links")
        state = _state(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
