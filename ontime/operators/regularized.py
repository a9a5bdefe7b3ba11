"""Boosting with second-order leaf values: every leaf answers its summed residuals over its rows plus a penalty."""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.operators.models import INPUT_PREFIX, VECTORS, _depth, _labelled, _preparation, _vectors
from ontime.sources.sinks import cut_lineage

CUT_ROUNDS = 10
DRAWS = 1 << 20


@dataclass
class Step:
    """One tree: the features it sees, its shape, and the value of each leaf, already times the step size."""

    features: list[int]
    tree: DecisionTreeRegressionModel
    values: list[float]

    def sliced(self, rows: DataFrame) -> DataFrame:
        return VectorSlicer(inputCol="features", outputCol="_chosen", indices=self.features).transform(rows)

    def added(self, rows: DataFrame, margin: str) -> DataFrame:
        """``rows`` with this tree's values added to ``margin``."""
        placed = self.tree.transform(self.sliced(rows))
        return placed.withColumn(margin, F.col(margin) + _by_leaf(self.values)).drop("_chosen", "_leaf", "_mean")


def _by_leaf(values: Sequence[float]) -> Column:
    return F.get(F.lit([float(v) for v in values]), F.col("_leaf").cast("int"))


@dataclass
class RegularizedTrees:
    preparation: PipelineModel
    base: float
    steps: list[Step]

    def transform(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """The rows with their prediction; all their own columns stay as they are."""
        rows = self.preparation.transform(df).withColumn(prediction, F.lit(self.base))
        for step in self.steps:
            rows = step.added(rows, prediction)
        inputs = [c for c in rows.columns if c.startswith(INPUT_PREFIX) and c not in df.columns]
        return rows.drop(*VECTORS, *inputs)


def fit_regularized_trees(
    df: DataFrame, features: Sequence[str], label: str, max_iter: int = 200, max_depth: int = 7, step: float = 0.005,
    subsample: float = 0.75, column_share: float = 0.75, penalty: float = 1.0, least_gain: float = 0.0, seed: int = 42,
    scale: bool = False,
) -> RegularizedTrees:
    """Slow boosting of squared error with a row and a column sample per tree and penalised leaves.

    Starts from the mean label. Spark grows the shape of every tree on the residuals of its rows and features, where a
    split must lower the variance by ``least_gain``; each leaf's value is then sum(residual) / (rows + ``penalty``), one
    aggregate whose result has a row per leaf. With no penalty the values are the tree's own means.
    Row samples follow a hash of the row, so that they do not depend on partitions; equal rows are drawn together.
    The margins are kept over the rounds and written to the shared folder every ``CUT_ROUNDS``. Rows without a label are
    left out; without any rows the base is 0 and there are no trees.
    """
    rows = _labelled(df, features, label)
    preparation = Pipeline(stages=_preparation(features, scale)).fit(rows)
    base = rows.agg(F.avg(label)).first()[0]
    if base is None:
        return RegularizedTrees(preparation, 0.0, [])
    start = _vectors(preparation, rows, label)[0].select("features", F.col(label).alias("_y"), F.lit(float(base)).alias("_margin"))
    state = cut_lineage(start.withColumn("_row", F.xxhash64(vector_to_array("features"), "_y")))
    rng = random.Random(seed)
    n_chosen = max(1, round(column_share * len(features)))
    grower = DecisionTreeRegressor(
        featuresCol="_chosen", labelCol="_rest", predictionCol="_mean", leafCol="_leaf", maxDepth=_depth(max_depth),
        minInfoGain=least_gain, seed=seed,
    )
    steps: list[Step] = []
    for number in range(1, max_iter + 1):
        chosen = sorted(rng.sample(range(len(features)), n_chosen))
        blank = Step(chosen, None, [])
        draw = F.pmod(F.xxhash64(F.lit(rng.randrange(1 << 31)), "_row"), F.lit(DRAWS))
        sample = state if subsample >= 1 else state.where(draw < round(subsample * DRAWS))
        seen = blank.sliced(sample).select("_chosen", (F.col("_y") - F.col("_margin")).alias("_rest"))
        tree = grower.fit(seen)
        sums = tree.transform(seen).groupBy("_leaf").agg(F.sum("_rest").alias("g"), F.count(F.lit(1)).alias("n"))
        values = [0.0] * (2 ** max_depth)
        for r in sums.collect():  # one row per leaf
            values[int(r["_leaf"])] = step * r["g"] / (r["n"] + penalty)
        steps.append(Step(chosen, tree, values[: _n_leaves(tree)]))
        after = steps[-1].added(state, "_margin")
        if number % CUT_ROUNDS == 0:
            moved = cut_lineage(after)
        else:
            moved = after.persist()
            moved.count()
        state.unpersist()
        state = moved
    state.unpersist()
    return RegularizedTrees(preparation, float(base), steps)


def _n_leaves(tree: DecisionTreeRegressionModel) -> int:
    return (tree.numNodes + 1) // 2
