"""Connected components of a table of links, by alternating stars.

Each round points every node at the smallest node it knows: first the larger
neighbours of each node (large star), then its smaller ones (small star). Rounds
stop when nothing changes, after about log2 of the longest chain. Everything is a
pre-aggregated minimum and a join with the written table of these minima, one row a
node, so AQE can split a node that a third of all links touch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a``, ``b``) that is not
    itself the smallest node of its component."""
    pairs = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a <> b").distinct(), "links")
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m")), "links-low")
        large = stored(both.filter("b > a").join(low, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "links-large")
        low = stored(large.groupBy("a").agg(F.min("b").alias("m")), "links-low")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter(
            "a <> b")
        pairs = stored(small.unionByName(low.withColumnRenamed("m", "b")).distinct(), "links")
        now = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
