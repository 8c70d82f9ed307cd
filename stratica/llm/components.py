"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratica.llm.common import written


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; a component is named by its smallest node.

    Large-star and small-star steps in turn (Kiveris et al., 2014) until nothing changes: every node
    is hung onto the smallest node it knows of, first all larger neighbours, then all smaller ones.
    The number of rounds grows with the logarithm of the longest path. Minima are summed before
    they move; a node with very many neighbours is a skewed join key, which Spark splits.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = written(links, "links")
    seen = _signature(links)
    while seen[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # from here on a > b in every link
        large = written(large.distinct(), "links")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = written(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = _signature(links)
        if now == seen:
            break
        seen = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select("b", "b").distinct().toDF("node", "component")
    )
