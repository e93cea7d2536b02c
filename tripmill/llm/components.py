"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import keep


def _lowest(links: DataFrame) -> DataFrame:
    """Per ``u`` the lowest of it and its ``v``, combined before the exchange."""
    return links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))


def _large_star(links: DataFrame) -> DataFrame:
    """Neighbours above a node now point to the lowest node around it."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = both.join(_lowest(both), "u").filter(F.col("v") > F.col("u"))
    return found.select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its neighbours below it now point to the lowest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = down.join(_lowest(down), "u")
    pointed = found.select(F.explode(F.array("u", "v")).alias("u"), F.col("low").alias("v"))
    return pointed.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v) for every linked node ``u`` but the lowest of its component, which is ``v``.

    ``links`` has two columns of one orderable type, in any direction, with repetitions.
    Each round is written to the shared folder, so a lost executor costs one round; the
    number of rounds grows with the logarithm of the longest chain. Joins carry no hint:
    adaptive execution splits the partition of a node that most links touch.
    """
    first, second = links.columns
    edges = links.select(F.col(first).alias("u"), F.col(second).alias("v"))
    edges = keep(edges.filter(F.col("u") != F.col("v")).distinct(), "links")
    state = None
    while True:
        edges = keep(_small_star(_large_star(edges)), "links")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            return edges
        state = now
