"""PageRank against a plain Python loop, with sinks, hubs and unknown endpoints."""

import random
from collections import Counter

import pytest

from ontime.operators.graph import pagerank


def brute_force(vertices, edges, reset=0.15, iters=5):
    kept = Counter((s, d) for s, d in edges if s in vertices and d in vertices)
    degree = Counter()
    for (s, _), n in kept.items():
        degree[s] += n
    rank = dict.fromkeys(vertices, 1.0)
    for _ in range(iters):
        received = Counter()
        for (s, d), n in kept.items():
            received[d] += rank[s] * n / degree[s]
        rank = {v: reset + (1 - reset) * received[v] for v in vertices}
    scale = len(vertices) / sum(rank.values())
    return {v: r * scale for v, r in rank.items()}


@pytest.mark.parametrize("options", [{}, {"hub_edges": 3}, {"iters": 3, "reset": 0.3}, {"stage_every": 2}])
def test_pagerank(spark, options):
    rng = random.Random(11)
    names = [f"v{i}" for i in range(30)]
    edges = [(rng.choice(names[:20]), rng.choice(names)) for _ in range(200)]
    edges += [("v0", v) for v in names]  # a hub; v20.. are sinks
    edges += [("v0", "unknown"), ("unknown", "v1"), (None, "v1")]
    vertices = spark.createDataFrame([(v,) for v in names + names[:3]], "id string")
    frame = spark.createDataFrame(edges, "src string, dst string")
    got = {r["id"]: r["pagerank"] for r in pagerank(vertices, frame, **options).collect()}
    known = {k: v for k, v in options.items() if k in ("iters", "reset")}
    assert got == pytest.approx(brute_force(names, edges, **known))
    assert sum(got.values()) == pytest.approx(len(names))


def test_every_round_reuses_the_shuffle_of_the_edges(spark, monkeypatch):
    from ontime.operators import graph

    written = []

    def recorded(df, *args):
        written.append(df)
        return stage_table(df, *args)

    stage_table = graph.stage_table
    monkeypatch.setattr(graph, "stage_table", recorded)
    edges = spark.createDataFrame([(f"v{i % 7}", f"v{i % 5}") for i in range(50)], "src string, dst string")
    pagerank(edges.selectExpr("src AS id"), edges, iters=4)
    ranks = written[-1]
    ranks.collect()
    final_plan = ranks._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final_plan.count("ReusedExchange") == 3
