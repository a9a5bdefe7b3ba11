"""Route graph: vertices, edges, edge aggregates, PageRank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions.columns import city_of
from ontime.operators.filters import filter_edges
from ontime.sources.sinks import stage_table

# Neighbours of one source that a single join key may carry.
HUB_EDGES = 1_000_000
DEGREE_SALT = 16


def build_graph(df: DataFrame, delay: str = "dep_delay", vertex: str = "origin") -> tuple[DataFrame, DataFrame]:
    """Vertices (distinct origins) and one edge per trip."""
    vertices = df.select(F.col(vertex).alias("id")).distinct()
    edges = df.select(
        F.col("origin_airport_seq_id").alias("trip_id"),
        F.col(delay).alias("delay"),
        F.col("origin").alias("src"),
        F.col("dest").alias("dst"),
        city_of("dest_city_name").alias("city_dst"),
        F.col("dest_state_abr").alias("state_dst"),
    )
    return vertices, edges


def edge_query(edges: DataFrame, end: str, code: str, keys: Sequence[str], agg: Column) -> DataFrame:
    """Aggregate of the delayed edges at a vertex, grouped by edge attributes."""
    return filter_edges(edges, end, code).groupBy(*keys).agg(agg)


def transition_weights(vertices: DataFrame, edges: DataFrame, hub_edges: int = HUB_EDGES) -> DataFrame:
    """Parallel edges collapsed to (src, part, dst, weight), with the number of parts of the source.

    The weight is the pair's share of the source's edges. Edges that leave the vertex set are dropped. Collapsing first
    means that everything after handles at most one row per pair of vertices, however many trips there are. A source
    with more than ``hub_edges`` neighbours is cut into parts, so that no join key carries more than about that many.
    """
    known = vertices.where(F.col("id").isNotNull()).select("id").distinct()
    linked = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    pairs = linked.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n_edges"))
    inside = pairs.join(known.withColumnRenamed("id", "src"), "src", "left_semi").join(
        known.withColumnRenamed("id", "dst"), "dst", "left_semi"
    )
    degree = inside.groupBy("src").agg(
        F.sum("n_edges").alias("out_degree"), F.ceil(F.count(F.lit(1)) / hub_edges).cast("int").alias("parts")
    )
    # a hub's pairs are spread over several tasks here too: the degrees are repeated once per salt value
    salted = degree.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(DEGREE_SALT - 1))))
    keyed = inside.withColumn("salt", F.pmod(F.xxhash64("dst"), F.lit(DEGREE_SALT)).cast("int"))
    return keyed.join(salted, ["src", "salt"]).select(
        "src",
        "parts",
        F.pmod(F.xxhash64("dst", F.lit(1)), F.col("parts")).cast("int").alias("part"),
        "dst",
        (F.col("n_edges") / F.col("out_degree")).alias("weight"),
    )


def pagerank(
    vertices: DataFrame,
    edges: DataFrame,
    reset: float = 0.15,
    iters: int = 5,
    stage_every: int = 10,
    hub_edges: int = HUB_EDGES,
) -> DataFrame:
    """Static PageRank: ranks start at 1, ``iters`` rounds, ranks scaled to sum up to the number of vertices.

    The collapsed edges are written once and every round reads them; their shuffle is the same in all rounds and thus
    reused. The ranks are written every few rounds to bound the plan.
    """
    weighted = stage_table(transition_weights(vertices, edges, hub_edges))
    parts = weighted.groupBy("src").agg(F.max("parts").alias("parts"))
    known = vertices.where(F.col("id").isNotNull()).select("id").distinct()
    split = stage_table(
        known.join(parts, known.id == parts.src, "left").select("id", F.coalesce("parts", F.lit(1)).alias("parts"))
    )
    # stating what the later joins imply keeps the plan of the edges, and so their shuffle, the same in every round
    weights = weighted.drop("parts").where("src IS NOT NULL AND part IS NOT NULL AND dst IS NOT NULL")
    split = split.where("id IS NOT NULL")
    silent = split.select("id", "parts", F.lit(0.0).alias("received"))
    ranks = split.withColumn("pagerank", F.lit(1.0))
    for step in range(1, iters + 1):
        sent = ranks.select(
            F.col("id").alias("src"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "pagerank"
        )
        # hash the ranks, not the edges: there are fewer, and the edges then need neither a sort nor a second shuffle
        received = weights.join(sent.hint("shuffle_hash"), ["src", "part"]).select(
            F.col("dst").alias("id"), F.lit(0).alias("parts"), (F.col("pagerank") * F.col("weight")).alias("received")
        )
        ranks = (
            silent.unionByName(received)
            .groupBy("id")
            .agg(F.max("parts").alias("parts"), F.sum("received").alias("received"))
            .select("id", "parts", (reset + (1 - reset) * F.col("received")).alias("pagerank"))
        )
        if step % stage_every == 0 and step < iters:
            ranks = stage_table(ranks)
    ranks = stage_table(ranks.select("id", "pagerank"))
    scale = ranks.agg((F.count(F.lit(1)) / F.sum("pagerank")).alias("scale")).scalar()
    return ranks.select("id", (F.col("pagerank") * scale).alias("pagerank"))
