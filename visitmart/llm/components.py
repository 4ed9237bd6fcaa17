"""Connected components by alternating large-star and small-star steps, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart.llm.common import join_spread, materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """(node, component) for each node that some edge joins to another; component is the smallest such node.

    Each round hangs every node on a smaller neighbour and halves the depth of chains, so that rounds grow
    with the logarithm of the longest chain. A round's edges are written to the shared folder; nothing is
    gathered by node: minima are aggregated before the shuffle, and the edges of a node meet its minimum in
    several tasks, however many they are. Self-loops, nulls and repeated edges are ignored.
    Edges that would need more than ``max_rounds`` rounds (a chain of 2^100 nodes) raise an error.
    """
    # u > v throughout
    now = materialize(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    before = None
    for _ in range(max_rounds):
        # one pass over the edges of the round before decides whether it changed anything
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = join_spread(both.where("v > u"), least, ["u"], "v").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u != v").distinct(), "hung")
        parent = large.groupBy("u").agg(F.min("v").alias("m"))
        small = join_spread(large, parent, ["u"], "v").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.union(parent.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "edges")
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
