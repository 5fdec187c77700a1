"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawlake.llm.common import join_counted, materialize


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for each node of ``links`` (a, b).

    Alternates two star steps: every node hands its larger neighbours, then its
    smaller ones, over to the smallest. Links never grow in number beyond nodes
    and links, the smallest node of a group of any size is one row, and every
    round is written, so that lost executors cost no more than a round.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    edges = materialize(edges, "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        least = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count(F.lit(1)).alias("n")), "least-neighbours")
        large = join_counted(both.filter(b > a), least, ["a"], "n").select(b.alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "large-stars")
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "least-smaller")
        small = join_counted(large, least, ["a"], "n").filter(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        edges = materialize(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-stars")
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    roots = edges.select("b").distinct()
    return edges.select(a.alias("node"), b.alias("root")).unionByName(roots.select(b.alias("node"), b.alias("root")))
