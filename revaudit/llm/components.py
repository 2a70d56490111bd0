"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revaudit.operators.scratch import settle


def _star(links: DataFrame, small: bool) -> DataFrame:
    """Tie each node's neighbours (all larger ones, or itself and all smaller ones) to the least of them."""
    both = links if small else links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # a is the larger end of a link in the small star
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    ties = both.join(least, "a")
    if small:
        out = ties.select(F.col("b").alias("x"), "m").unionByName(least.select(F.col("a").alias("x"), "m"))
    else:
        out = ties.where("b > a").select(F.col("b").alias("x"), "m")
    return out.where("x <> m").distinct().select(F.col("x").alias("a"), F.col("m").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """node, label: the least node of its component, for every node of the links (a, b).

    Links of a node to itself and repeated links add nothing; nulls are left out. Every step is written to the
    shared folder. The number of steps grows with the logarithm of the longest path.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = settle(links, "components")
    seen = None
    while True:
        links = settle(_star(_star(links, small=False), small=True), "components")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    own = links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("label"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(own)
