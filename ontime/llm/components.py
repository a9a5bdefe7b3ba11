"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import stage


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): component is the smallest node that can be reached.

    Every node hangs its larger neighbours under the smallest one it knows (large-star), then its smaller ones
    (small-star), until all edges lead to a root. Each half round is one aggregation and one join over the edges; nothing
    is gathered per node, and each round is written out. Null ends and loops are left out.
    """
    ends = links.where("a <> b")
    edges = stage(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = _mark(edges)
    while True:
        edges = stage(_small_star(_large_star(edges)), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = edges.select(F.col("v").alias("w"), "u")  # of each edge, the larger end moves
    return larger.join(least, "w").select("u", F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    own = least.select(F.col("w").alias("u"), F.col("m").alias("v"))
    moved = edges.join(least, F.col("u") == F.col("w")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.unionByName(moved).distinct()
