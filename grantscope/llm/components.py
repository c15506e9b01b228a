"""Connected components of a link table, by alternating large-star and small-star contraction.

Every round is two grouped minima joined back to the links (no list of neighbours is ever collected), written to the
shared folder, so lineage stays short and a lost executor costs one round. It ends when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantscope.llm.common import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_least(links: DataFrame) -> DataFrame:
    """Links and the least node ``m`` among ``a`` and its neighbours in ``links``."""
    least = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    return links.join(least, F.col("a") == F.col("node")).select("a", "b", F.least("a", "m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Each neighbour larger than the node links to the node's least neighbour instead."""
    out = _with_least(_both_ways(links)).where("b > a")
    return out.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours link to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    out = _with_least(down)
    smaller = out.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return smaller.unionByName(out.select("a", F.col("m").alias("b")))


def _sign(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b: long): ``root`` is the least node of its component."""
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    sign = _sign(links)
    while True:
        links = stored(_small_star(_large_star(links)).distinct(), "links")
        before, sign = sign, _sign(links)
        if sign == before:
            break
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
