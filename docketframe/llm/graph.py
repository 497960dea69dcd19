"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketframe.session import discard, staged


def component_labels(links: DataFrame) -> DataFrame:
    """node, label: the smallest node of its component, for all nodes with links (a, b).

    Large-star and small-star rounds: each node's neighbours are moved to its
    smallest neighbour until the links are stars.  The minima are aggregated
    before the shuffle, so a node with very many links does no harm.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        after = staged(small.where("a <> b").distinct())
        # Stars: no node hangs on two others, none that others hang on hangs itself.
        counts = after.agg(F.count("*"), F.countDistinct("a")).first()
        settled = counts[0] == counts[1] and after.join(after.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty()
        discard(edges)
        edges = after
        if settled:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
