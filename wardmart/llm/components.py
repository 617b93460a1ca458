"""Connected components of links, by stars that grow and shrink in turn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node it reaches) of every node that ``links`` (a, b) joins.

    In each round every node's larger neighbours are joined to its smallest one, then every
    node's smaller ones to the least of them. Each edge moves toward the smallest node, the
    number of edges never grows, and the rounds grow with the logarithm of the longest path.
    A node with very many links is one counter in the minimum and a skewed side of a join,
    which adaptive execution splits. Self links and null ends are left out.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()
    edges = written(edges, "edges")
    before = _state(edges)
    while before[0]:
        ends = edges.select("high", "low").unionAll(edges.select(F.col("low"), F.col("high")))
        least = (ends.toDF("node", "other").groupBy("node").agg(F.min("other").alias("least"))
                 .select("node", F.least("node", "least").alias("least")))
        grown = edges.join(least, F.col("low") == F.col("node")).select("high", F.col("least").alias("low")).distinct()
        root = grown.groupBy("high").agg(F.min("low").alias("root"))
        shrunk = (
            grown.join(root, "high").where("low <> root").select(F.col("low").alias("high"), F.col("root").alias("low"))
            .unionAll(root.select("high", F.col("root").alias("low"))).distinct())
        edges = written(shrunk, "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return nodes.unionAll(edges.select("low", "low").toDF("node", "component")).distinct()
