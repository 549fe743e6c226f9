"""Connected components of a graph of any size, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from narrata.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node of ``edges`` (a, b).

    Large-star and small-star rounds: each node hands its larger neighbours, then its smaller ones, to the smallest
    neighbour it knows. Every round is written to the shared folder; a star forest remains, in a number of rounds that
    grows with the logarithm of the longest path. Nodes with many neighbours are first reduced within each task.
    """
    edges, now = watched(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        ways = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = edges.join(least.withColumnRenamed("a", "b"), "b").select("a", F.col("m").alias("b")).filter("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        before = now
        edges, now = watched(small)
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def watched(edges: DataFrame) -> tuple[DataFrame, dict]:
    """``edges``, staged, and a checksum of them that is taken while they are written."""
    seen = Observation()
    staged = stage(edges.observe(seen, F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("sum")))
    return staged, seen.get
