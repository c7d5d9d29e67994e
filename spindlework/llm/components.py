"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root: the smallest node reached.

    Each round hangs every larger neighbour, then every smaller one, on the least node
    around, which halves distances; minima are combined map-side and no neighbour list is
    gathered.  Rounds are written to the shared folder.  The end is told by the edges'
    count and digest sum.
    """
    now = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    now, before = store(now, "edges"), None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("n"), F.least("a", "m").alias("m")
        )
        large = both.join(low, F.col("a") == F.col("n")).filter("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")
        ).filter("a <> b").distinct()
        large = store(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = large.join(low, F.col("a") == F.col("n")).select(
            F.col("b").alias("a"), F.col("m").alias("b")
        ).filter("a <> b").unionByName(low.select(F.col("n").alias("a"), F.col("m").alias("b")))
        now = store(small.distinct(), "small-star")
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
