"""Connected components of a link table, by alternating star contraction.

Each round sends every node's larger neighbours to its smallest neighbour, then
every node's smaller neighbours to their smallest; the links left at the end are
(node, smallest node of its component).  Rounds grow with the logarithm of the
longest path.  Only aggregates and joins: no neighbour list is gathered, so a
node with very many links is one row of a map-side combined minimum, and its
links are joined by a plain shuffle join that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidgraph.llm.common import scratch


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
                    F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["x"], row["s"]


def _star(links: DataFrame, name: str, large: bool) -> DataFrame:
    """One star step over ``a > b`` links."""
    if large:  # neighbours on both sides
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lows = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        lows = scratch(lows, "star-minima")
        moved = both.where("b > a").join(lows, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:  # smaller neighbours only
        lows = scratch(links.groupBy("a").agg(F.min("b").alias("low")), "star-minima")
        moved = links.join(lows, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a > b")
        moved = moved.unionByName(lows.select("a", F.col("low").alias("b")))
    return scratch(moved.distinct(), name)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a``, ``b``: any
    comparable ids, nulls and loops ignored); the root is the smallest node."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = scratch(links.distinct(), "links")
    before = _signature(links)
    while before[0]:
        links = _star(_star(links, "large-star", True), "small-star", False)
        after = _signature(links)
        if after == before:
            break
        before = after
    roots = links.groupBy("b").agg(F.lit(None).alias("x")).select(F.col("b").alias("node"), F.col("b").alias("root"))
    return scratch(links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots), "components")
