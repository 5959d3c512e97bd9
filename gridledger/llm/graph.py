"""Connected components of links between numbered nodes, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import join_counted, kept


def _with_least(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The links of each node a with the least of it and its neighbours, m, and the table of a and m."""
    least = kept(links.groupBy("a").agg(F.min("b").alias("b"), F.count(F.lit(1)).alias("n")).select("a", F.least("a", "b").alias("m"), "n"), "least")
    return join_counted(links, least, ["a"]), least


def _large_star(links: DataFrame) -> DataFrame:
    """Links each node's larger neighbours to the least of its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _with_least(both)[0].where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    joined, least = _with_least(down)
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node with a link to another; the root is the least node of the component.

    ``links`` has long columns ``a`` and ``b``; repeated links, loops and both directions are allowed. Every round is
    written to the shared folder, and the number of rounds grows with the logarithm of the component size.
    """
    links = kept(links.select("a", "b").where("a <> b").distinct(), "links")
    while True:
        links = kept(_large_star(links).distinct(), "links")
        links = kept(_small_star(links).distinct(), "links")
        inner = links.select(F.col("b").alias("a")).distinct().join(links, "a", "left_semi")
        if inner.isEmpty() and links.groupBy("a").count().where("count > 1").isEmpty():
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
