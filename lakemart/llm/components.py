"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemart.llm.tables import Scratch


def _stars(pairs: DataFrame) -> DataFrame:
    """One round: every node hands its larger neighbours, then its smaller ones, to its smallest.

    ``pairs`` holds (u, v) with u > v. Only minima per node are aggregated and joined back, so a
    node with a third of all links is combined map-side and never gathered.
    """
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    large = (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(
        F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")
    )
    return small.where("u > v").distinct()


def _state(pairs: DataFrame) -> tuple:
    """Rows and an order-free digest: equal for equal lists."""
    digest = F.xxhash64("u", "v")
    return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(digest), F.sum(digest % 1000003)).first())


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): each linked node with the smallest node that links reach from it.

    ``links`` has the long columns a and b in any order, repeats and self links allowed; nodes
    without a link to another node are not returned. Rounds are written to the shared folder.
    """
    pairs = scratch.write(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before = _state(pairs)
    while before[0]:
        after = scratch.write(_stars(pairs), "links")
        now = _state(after)
        scratch.drop(pairs)
        pairs = after
        if now == before:
            break
        before = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
