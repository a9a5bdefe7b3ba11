"""Nested tree ensembles: the first trees of a fitted ensemble are the smaller ensemble, so one fit serves all sizes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.operators.aggregates import regression_metrics
from ontime.sources.sinks import drop_stage, stage_path, stage_table

Ensemble = RandomForestRegressionModel | GBTRegressionModel


def first_trees(model: Ensemble, n: int) -> Ensemble:
    """The ensemble of the first ``n`` trees, with the same columns and parameters; the given one stays as it is.

    For boosting this is the model that ``n`` rounds with the same seed fit; for forests it is a forest of ``n`` trees.
    """
    if not 1 <= n <= model.getNumTrees:
        raise ValueError(f"{n} of {model.getNumTrees} trees")
    java, jvm = model._java_obj, SparkContext._active_spark_context._jvm
    regression, trees = jvm.org.apache.spark.ml.regression, java.trees()[:n]
    if isinstance(model, GBTRegressionModel):
        smaller = regression.GBTRegressionModel(java.uid(), trees, java.treeWeights()[:n], java.numFeatures())
    else:
        smaller = regression.RandomForestRegressionModel(java.uid(), trees, java.numFeatures())
    java.copyValues(smaller, jvm.org.apache.spark.ml.param.ParamMap())
    smaller.set(smaller.getParam("maxIter" if isinstance(model, GBTRegressionModel) else "numTrees"), n)  # forests divide by it
    out = type(model)(smaller)
    out._transfer_params_from_java()
    return out


def joined_trees(models: Sequence[RandomForestRegressionModel]) -> RandomForestRegressionModel:
    """One forest of the trees of all, in their order, with the columns and other parameters of the first."""
    if len(models) == 1:
        return models[0]
    context, first = SparkContext._active_spark_context, models[0]._java_obj
    regression = context._jvm.org.apache.spark.ml.regression
    found = [tree for model in models for tree in model._java_obj.trees()]
    trees = context._gateway.new_array(regression.DecisionTreeRegressionModel, len(found))
    for i, tree in enumerate(found):
        trees[i] = tree
    whole = regression.RandomForestRegressionModel(first.uid(), trees, first.numFeatures())
    first.copyValues(whole, context._jvm.org.apache.spark.ml.param.ParamMap())
    whole.set(whole.getParam("numTrees"), len(found))
    out = RandomForestRegressionModel(whole)
    out._transfer_params_from_java()
    return out


def prefix_metrics(model: Ensemble, sizes: Sequence[int], vectors: DataFrame, label: str) -> dict[int, Mapping[str, Any]]:
    """mse, rmse, mae and r2 of the first trees for every size, in one pass over the rows; no entry without rows."""
    scored = vectors
    for n in sizes:
        scored = first_trees(model, n).setPredictionCol(f"_p{n}").transform(scored)
    rows = F.array(*[F.struct(F.lit(n).alias("_n"), F.col(f"_p{n}").alias("_predicted")) for n in sizes])
    metrics = regression_metrics(scored.select(label, F.inline(rows)), label, "_predicted", ["_n"])
    return {row["_n"]: row.asDict() for row in metrics.collect()}  # one row per size


def summed_metrics(
    parts: Iterable[RandomForestRegressionModel], sizes: Sequence[int], vectors: DataFrame, label: str
) -> dict[int, Mapping[str, Any]]:
    """As ``prefix_metrics``, for a forest that comes in parts of which one ends at every size.

    The rows carry the sum of the trees' predictions from part to part, so that no task needs the whole forest.
    """
    spark, scored, last, grown, found = vectors.sparkSession, vectors.withColumn("_sum", F.lit(0.0)), None, 0, {}
    for part in parts:
        path = stage_path(spark, "sums")
        answered = part.transform(scored, {part.predictionCol: "_mean"})
        added = (F.col("_sum") + F.col("_mean") * part.getNumTrees).alias("_sum")
        scored = stage_table(answered.select("features", label, added), path)
        if last:
            drop_stage(spark, last)
        last, grown = path, grown + part.getNumTrees
        if grown in sizes:
            means = scored.select(label, F.lit(grown).alias("_n"), (F.col("_sum") / grown).alias("_predicted"))
            found |= {grown: r.asDict() for r in regression_metrics(means, label, "_predicted", ["_n"]).collect()}
    if last:
        drop_stage(spark, last)
    return found


@dataclass(frozen=True)
class SavedEnsemble:
    """A candidate of a search: where the trees of its group are saved, in parts, and how many of them count."""

    paths: tuple[str, ...]
    num_trees: int

    def load(self) -> PipelineModel:
        parts = [PipelineModel.load(path) for path in self.paths]
        whole = joined_trees([part.stages[-1] for part in parts])
        return PipelineModel([*parts[0].stages[:-1], first_trees(whole, self.num_trees)])


class SavedModels(Sequence):
    """Models of a search in the order of its candidates. They are on disk; an item is loaded when it is asked for."""

    def __init__(self, saved: Sequence[SavedEnsemble] = ()):
        self.saved = list(saved)

    def __len__(self) -> int:
        return len(self.saved)

    def __getitem__(self, index):
        return SavedModels(self.saved[index]) if isinstance(index, slice) else self.saved[index].load()

    def __add__(self, other: SavedModels) -> SavedModels:
        return SavedModels([*self.saved, *other.saved])


def nested_groups(candidates: Sequence[Mapping[str, Any]], default_size: int) -> list[tuple[dict[str, Any], dict[int, int]]]:
    """Candidates that differ in ``num_trees`` only, together: (settings with the largest number, size of each index)."""
    groups: dict[tuple, dict[int, int]] = {}
    for i, settings in enumerate(candidates):
        others = tuple(sorted((k, v) for k, v in settings.items() if k != "num_trees"))
        groups.setdefault(others, {})[i] = settings.get("num_trees", default_size)
    return [({**dict(others), "num_trees": max(sizes.values())}, sizes) for others, sizes in groups.items()]
