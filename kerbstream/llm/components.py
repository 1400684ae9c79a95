"""Connected components of an undirected graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstream.session import materialise


def _state(edges: DataFrame) -> tuple:
    """A checksum of a set of edges: two numbers reach the driver, no edges."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (or smaller) neighbours, and then itself, on its smallest one."""
    linked = _both_ways(edges)
    least = linked.groupBy("a").agg(F.min("b").alias("_least"))
    # Written, so that the join sees a plain shuffle on both sides and can split hot nodes.
    least = materialise(least.select("a", F.least("a", "_least").alias("_least")), "least")
    pairs = linked.join(least, "a")
    if large:
        pairs = pairs.filter("b > a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    else:
        below = pairs.filter("b < a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
        own = least.select("a", F.col("_least").alias("b"))
        pairs = below.unionByName(own)
    return pairs.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for each node of ``edges`` (a, b).

    Large and small stars alternate until nothing changes, which takes about as many rounds as
    the logarithm of the longest chain. Each round is written, so a lost executor costs at most
    one round, and lineage stays short. Loops and repeated edges do no harm; an empty graph
    has no components.
    """
    now = materialise(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before, state = None, _state(now)
    while state != before and state[0]:
        now = materialise(_star(materialise(_star(now, large=True), "large"), large=False),
                          "small")
        before, state = state, _state(now)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots).distinct()
