"""Connected components of an edge table, as DataFrame joins.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond"): each step is one aggregate (the smallest
neighbour) and one join on the node, never a list of neighbours, so a hub of any
degree is spread by the join's skew handling.  Every round is cut to the shared
folder; the driver sees two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortproof.llm.frames import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v) with u > v.  One star step; the result again has u > v."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else edges
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # joined on ~u, not u: both sides are then dealt anew for the join, which lets
    # Spark split the partition of a hub (it can't above an aggregate's exchange)
    moved = near.withColumn("k", F.bitwise_not("u")).join(
        least.select(F.bitwise_not("u").alias("k"), "m"), "k").select(
        F.col("v").alias("x"), "m", F.col("u").alias("self"))
    if large:
        # neighbours greater than the node link to its smallest neighbour
        out = moved.where("x > self").select(F.col("x").alias("u"), F.col("m").alias("v"))
    else:
        # smaller neighbours and the node itself link to the smallest
        out = moved.select(F.explode(F.array("x", "self")).alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").dropDuplicates(["u", "v"])


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a long, b long) edges -> (node, component): component is the smallest node.

    Nodes without an edge do not appear.  Null ends and loops are ignored,
    repeated and reversed edges are allowed, an empty table gives an empty one.
    Raises when ``max_rounds`` do not suffice (rounds grow with the logarithm of
    the nodes).
    """
    e = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))
    e = cut(e.dropDuplicates(["u", "v"]))
    before = None
    for _ in range(max_rounds):
        e = cut(_star(_star(e, True), False))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    leaves = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionAll(roots)
