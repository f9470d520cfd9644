"""Connected components of a link table, without collecting links or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.session import materialise


def components(links: DataFrame, node: str) -> DataFrame:
    """(`node`, root) for every end of a link `a`, `b`; root is the smallest node of its component.

    Alternates two star steps until nothing changes: every node hangs its larger neighbours on its
    smallest neighbour, then its smaller ones. The number of rounds grows with the logarithm of the
    longest chain. Each round is a written table, so lost executors cost one round at most.
    """
    edges = links.filter("a != b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()
    edges = materialise(edges, "edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        least = both.groupBy("lo").agg(F.least("lo", F.min("hi")).alias("m"))
        # larger neighbours move to the smallest one
        large = both.filter("hi > lo").join(least, "lo").select(F.col("m").alias("lo"), "hi").distinct()
        large = materialise(large, "large-star")
        # each node and its smaller neighbours move to the smallest of them
        small_least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(small_least, "hi")
        nodes = moved.select(F.col("m").alias("lo"), F.col("lo").alias("hi")).unionByName(moved.select(F.col("m").alias("lo"), "hi"))
        small = materialise(nodes.filter("lo != hi").distinct(), "small-star")
        # done when every larger end has one smaller end that is itself no larger end
        open_ends = small.join(small.select(F.col("hi").alias("_h")), F.col("lo") == F.col("_h"), "left_semi")
        settled = open_ends.isEmpty() and small.groupBy("hi").count().filter("count > 1").isEmpty()
        edges = small
        if settled:
            break
    roots = edges.select(F.col("hi").alias(node), F.col("lo").alias("root"))
    tops = edges.select(F.col("lo").alias(node), F.col("lo").alias("root")).distinct()
    return roots.unionByName(tops)
