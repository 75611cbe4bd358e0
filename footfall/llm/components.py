"""Connected components of a table of links, in rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import drop_staged, stage


def _stamp(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1] or 0


def tied(links: DataFrame, least: DataFrame, large: bool) -> DataFrame:
    """Links of a node's larger (or smaller) neighbours to its least one.

    Both sides are staged, so no aggregate stands between the join and its shuffle, and AQE can split a
    node that has a large part of all links.
    """
    if large:
        return _both_ways(links).join(least, "a").filter(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.least("a", "m").alias("b"))
    return links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b")))


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One half round, staged; ``links`` has the greater node in ``a`` and is staged."""
    near = _both_ways(links) if large else links
    least = stage(near.groupBy("a").agg(F.min("b").alias("m")), "least")
    result = stage(
        tied(links, least, large).filter(F.col("a") != F.col("b")).select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    drop_staged(least)
    return result


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node with a link to another; the root is the least node.

    ``links`` has columns ``a`` and ``b`` of one type. Every half round is staged, so lost executors cost
    one; the number of rounds grows with the logarithm of the longest chain.
    """
    current = stage(links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    stamp = _stamp(current)
    while stamp[0]:
        half = _star(current, True)
        following = _star(half, False)
        drop_staged(current)
        drop_staged(half)
        before, stamp, current = stamp, _stamp(following), following
        if stamp == before:
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
