"""Connected components of a table of links, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import gathered


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest node it knows."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    linked = both.filter("b > a").join(least, F.col("a") == F.col("node"))
    return linked.select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m")).withColumnRenamed("b", "node")
    linked = edges.join(least, F.col("b") == F.col("node")).filter("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return linked.unionByName(least.select(F.col("m").alias("a"), F.col("node").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node that links
    lead to. Each round is two joins on nodes and is written to the shared folder; rounds
    end when nothing changes, after about the logarithm of the longest chain. Nulls and
    links of a node to itself are left out; no links give an empty result."""
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    edges, before = gathered(edges, "links"), None
    while True:
        count, total = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (count, total) == before or not count:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
                edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
            )
        before = (count, total)
        edges = gathered(_small_star(_large_star(edges)), "stars")
