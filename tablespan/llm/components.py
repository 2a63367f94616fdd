"""Connected components of a graph given as a table of edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablespan.llm.common import stage_table


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) for every node of `edges` (a long, b long, neither null).

    Each round every node points its larger neighbours, then its smaller ones, at the smallest node it knows. A table
    is written per round; rounds grow with the logarithm of the longest chain. Neighbours of a node are never gathered:
    their minimum is pre-aggregated and joined back, where a node with very many neighbours can be split."""
    now = stage_table(_both_ways(edges.filter("a <> b")).distinct(), "edges")
    state = _signature(now)
    while True:
        least = now.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = now.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = large.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b")
        small = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        down = small.groupBy("a").agg(F.min("b").alias("m"))
        small = small.join(down, "a").select("a", "b", "m")
        small = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            down.select("a", F.col("m").alias("b"))).distinct()
        now = stage_table(_both_ways(small).distinct(), "edges")
        before, state = state, _signature(now)
        if state == before:
            break
    return now.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
                    F.sum(F.xxhash64("b", "a").bitwiseAND(F.lit((1 << 31) - 1))).alias("s")).first()
    return tuple(row)
