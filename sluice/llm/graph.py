"""Connected components of an edge table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import discard, stored


def _neighbours_and_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge from u, with the least node m among u and its neighbours.
    The aggregate is partial before its shuffle and the join is one that adaptive
    execution splits, so a node with very many edges does not fill one task."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, root): the smallest node of each node's component.

    Alternates the large-star and small-star steps of the public two-phase
    algorithm until the edges are stars around the smallest nodes.  Nodes without
    an edge to another node, null ends and self links don't appear.  Each round is
    a written table, which goes when the next is there; the driver sees one count and
    one checksum a round.  Rounds follow until the edges no longer change, of which the
    algorithm needs about the square of the logarithm of the number of nodes at most.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links, before = stored(links), None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _neighbours_and_least(both).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = _neighbours_and_least(large)
        now = stored(down.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v"))).distinct())
        discard(links)
        links = now
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(links.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
