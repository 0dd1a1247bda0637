"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linenet.llm.scratch import written


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``component`` (the least node reachable) for every node of an edge.

    Each round links every node to the least of its neighbours, first its larger ones,
    then its smaller ones, until nothing changes; rounds grow with the logarithm of the
    longest path. A node with very many neighbours is one key of an ordinary join, which
    adaptive execution splits. Edges with a null end and loops are left out; repeated
    edges count once; no edge gives no row.
    """
    links = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u is not null and v is not null and u <> v")
    links = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    seen = None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = mark
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "cc-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "cc-small")
