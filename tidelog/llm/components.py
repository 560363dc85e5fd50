"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import written


def _total(values: Column) -> Column:
    """Sum of longs, whose own sum a long may not hold."""
    return F.sum(values.cast("decimal(28,0)"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links(a, b)``: the smallest node it
    reaches. Each round sends every neighbour to the smallest node around, by
    pre-aggregated minima and joins that adaptive execution may split; rounds
    grow with the logarithm of a component's size. A node of many neighbours
    is never gathered in one task."""
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "links")
    was = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # every edge now points down: a > b
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.union(down.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), _total(F.xxhash64("a", "b"))).first()
        if now == was:
            break
        was = now
    labels = edges.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias("node"), "label")
    return labels.union(edges.select("b", "b").distinct().toDF("node", "label"))
