"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import discard, stored


def _minimum(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _minimum(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _minimum(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v): the smallest node reachable.

    Each round hangs every node below the smallest one it knows, so that a chain is halved.
    The links after a round are written to the shared folder; only a count and a sum of them
    reach the driver, which stops once a round changes nothing. A graph that still changes after
    ``rounds`` rounds is an error: 40 serve paths of 2 ** 40 nodes.
    """
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    before = None
    for _ in range(rounds):
        size = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if size[0] == 0 or size == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", F.col("v").alias("component"))).distinct()
        before = size
        after = stored(_small_star(_large_star(now)), "links")
        discard(now)
        now = after
    raise RuntimeError(f"components still change after {rounds} rounds")
