"""Connected components of a table of links, in rounds of joins and small aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import discard, stored


def _nearest(links: DataFrame, node: str, other: str) -> DataFrame:
    """Per `node` the smallest of it and its `other` ends."""
    return links.groupBy(node).agg(F.least(F.col(node), F.min(other)).alias("low"))


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for the nodes of `links` (columns a, b, both long).

    Alternates two steps until nothing changes: every node hangs its larger neighbours under its
    smallest one, then its smaller neighbours. Rounds grow with the logarithm of the longest chain.
    Only aggregates and joins are used, so a hub's neighbours are never gathered in one place.
    Rows with a null end are no links. Repeated links and links of a node to itself change nothing.
    """
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_nearest(both, "a", "b"), "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        low = _nearest(large, "a", "b")
        small = large.join(low, "a").select(F.greatest("b", "low").alias("x"), F.col("low").alias("b"))
        small = small.where("x <> b").select(F.col("x").alias("a"), "b").union(low.select("a", F.col("low").alias("b")))
        last, links = links, stored(small.where("a <> b").distinct(), "links")
        discard(last)
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(links.select("b", "b")).groupBy("node").agg(F.min("component").alias("component"))
