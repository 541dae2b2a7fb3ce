"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.session import materialize, release

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v > m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("u", "m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) → (node, root): the smallest node each node can reach.

    Every round is two partial minimum aggregates and joins on the node, so a node with
    millions of links is reduced map-side and no neighbour list is ever built. Rounds are
    staged in the shared checkpoint folder; their number grows with the logarithm of the
    longest chain. No edges: no rows. Self-loops, repeated and reversed edges are allowed;
    edges with a null end are ignored.
    """
    edges = edges.toDF("a", "b").where("a != b").distinct()
    state, before = materialize(edges, "cc"), None
    for _ in range(MAX_ROUNDS):
        print_ = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if print_ == before or not print_[0]:
            return state.toDF("node", "root").union(state.select("b", "b").distinct())
        before = print_
        nxt = materialize(_small_star(_large_star(state)).where("a != b").distinct(), "cc")
        release(state)
        state = nxt
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
