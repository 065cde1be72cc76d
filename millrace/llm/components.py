"""Connected components over a table of links, by alternating large-star and small-star rounds.

Each round is two aggregates and joins on vertex ids; a vertex with very many neighbours is reduced map-side to its least
neighbour and its join is split by adaptive execution. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _star(pairs: DataFrame) -> DataFrame:
    """(u, v) with v a neighbour of u: link every v and u to the least vertex among u and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u").select("u", "v", "m")


def _round(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    large = _star(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    down = stage(large, "large").select(F.col("a").alias("u"), F.col("b").alias("v"))  # a > b: lower neighbours only
    small = _star(down)
    return (
        small.select(F.col("v").alias("a"), F.col("m").alias("b"))
        .unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
        .where("a <> b")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) between any ordered ids -> (node, root): every linked node with the least node it can reach.

    Nulls are left out; links of a node with itself, both directions and repeated links do no harm; no links, no rows.
    """
    now = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        now = stage(_round(now), "round")
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == mark:
            break
        mark = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
