"""Connected components of a large edge table, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.session import materialize


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return joined.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), two longs each; returns (node, component): the smallest node that can be reached, for every node
    that has an edge to another one.

    Each step is a minimum per node and a join; neighbour lists are never collected, and a node with very many
    edges is pre-aggregated or split by AQE.  Each round is written to the checkpoint folder.
    """
    now = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = materialize(_small_star(_large_star(now)), "edges")
        after = _state(now)
        if after == state:
            break
        state = after
    star = now.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("component"))
    return star.unionAll(star.select(F.col("component").alias("node"), "component")).distinct()
