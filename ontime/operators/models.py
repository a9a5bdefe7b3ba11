"""Regression models on Spark ML: split, fit, search, score, compare, promote."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product
from math import prod
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, SQLTransformer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.functions.columns import ColumnLike, as_column, null_nan, run_id
from ontime.operators.ensembles import (
    SavedEnsemble, SavedModels, joined_trees, nested_groups, prefix_metrics, summed_metrics,
)
from ontime.sources.scans import HASH_DIGITS, hash_below
from ontime.sources.sinks import create_exclusively, drop_stage, ensure_checkpoint_dir, stage_path, stage_table

MAX_TREE_DEPTH = 30
RUN_COLUMNS = ("model", "dataset", "target", "num_trees", "max_depth", "feature_subset", "step_size", "subsample")
METRICS = ("mse", "rmse", "mae", "r2")
RUN_SCHEMA = (
    "model string, dataset string, target string, num_trees int, max_depth int, feature_subset string, "
    "step_size double, subsample double, mse double, rmse double, mae double, r2 double"
)


def split_train_test(
    df: DataFrame, key: ColumnLike | Sequence[ColumnLike], fraction: float = 0.75, seed: int = 99
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of the key: disjoint, complete and the same on every run."""
    keys = list(key) if isinstance(key, (list, tuple)) else [key]
    in_train = hash_below(keys, fraction, str(seed))
    return df.where(in_train), df.where(~in_train)


def hash_folds(df: DataFrame, key: ColumnLike, folds: int, seed: int = 42, output: str = "fold") -> DataFrame:
    """Fold number of each row from the MD5 of its key, as for the split; a missing key counts as empty."""
    text = F.concat_ws("|", F.lit(str(seed)), F.coalesce(as_column(key).cast("string"), F.lit("")))
    number = F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("long")
    return df.withColumn(output, F.pmod(number, F.lit(folds)).cast("int"))


def _subset(name: str) -> str:
    # "auto" stands for all features, as it does in the runs logged so far; Spark's own "auto" means a third of them
    return "all" if name == "auto" else name


def _depth(value: int) -> int:
    if not 0 <= value <= MAX_TREE_DEPTH:
        raise ValueError(f"tree depth {value} is outside 0..{MAX_TREE_DEPTH}")
    return value


INPUT_PREFIX = "in_"
VECTORS = ("assembled", "features")


def _zero_filled(features: Sequence[str]) -> SQLTransformer:
    """Pipeline stage that copies every feature as a double, 0 where it is missing or no number."""
    filled = [
        f"coalesce(nanvl(try_cast(`{f}` AS double), CAST(NULL AS double)), 0D) AS `{INPUT_PREFIX}{f}`" for f in features
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__")


def _preparation(features: Sequence[str], scale: bool) -> list[Any]:
    inputs = [INPUT_PREFIX + f for f in features]
    assembled = "assembled" if scale else "features"
    stages: list[Any] = [_zero_filled(features), VectorAssembler(inputCols=inputs, outputCol=assembled)]
    if scale:
        stages.append(MinMaxScaler(inputCol=assembled, outputCol="features"))
    return stages


ROW_BYTES = 100  # that Spark keeps of a row besides four bytes per feature and, for forests, per tree
BOOSTING_BYTES = 120  # more of a row, for boosting: its residual and its predictions in the latest rounds
TASK_BYTES = 512 << 20
LEAST_TREES = 10
GATHERED_ROWS = 1 << 18  # from so many rows on, forests read them in the order of a first tree's leaves
GATHERED_DEPTH = 10
NODE_BYTES = 400  # that the driver keeps of a node while its tree is grown
SHALLOW = 10  # deeper trees may have nodes for every few rows


def _row_bytes(features: Sequence[str], trees: int) -> int:
    return ROW_BYTES + 4 * (len(features) + trees)


def _used(df: DataFrame) -> tuple[int, int]:
    """Partitions that have rows, and the number of rows."""
    return tuple(df.select(F.spark_partition_id().alias("_part")).agg(F.count_distinct("_part"), F.count("*")).first())


def _n_parts(spark: SparkSession, n: int, row_bytes: int) -> int:
    """As many partitions as there are task slots, or a multiple of that when a task would hold more than ``TASK_BYTES``.

    Trees are grown by many scans, and every partition adds the statistics of all nodes to each shuffle: a few partitions
    more than slots cost a second wave in every scan, many more cost shuffles.
    """
    slots = spark.sparkContext.defaultParallelism
    return slots * max(1, -(-n * row_bytes // (TASK_BYTES * slots)))


def _vectors(preparation: PipelineModel, rows: DataFrame, label: str, row_bytes: int = ROW_BYTES) -> tuple[DataFrame, int]:
    """The prepared rows in the partitions for a fit, and their number."""
    vectors = preparation.transform(rows).select("features", label)
    used, n = _used(rows)
    wanted = _n_parts(rows.sparkSession, n, row_bytes)
    return (vectors if used == wanted else vectors.repartition(wanted)), n


def _staged(vectors: DataFrame, n: int, row_bytes: int) -> DataFrame:
    """The vectors, written once; dealt anew where the reader cuts the files into other pieces than were written."""
    staged = stage_table(vectors)
    used, wanted = _used(staged)[0], _n_parts(vectors.sparkSession, n, row_bytes)
    few = wanted > vectors.sparkSession.sparkContext.defaultParallelism and used < wanted
    return staged.repartition(wanted) if few or used > wanted else staged


def _room(spark: SparkSession) -> int:
    """Bytes that fits may keep: three quarters of the storage memory."""
    status = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().valuesIterator()
    memory = 0
    while status.hasNext():
        memory += status.next()._1()
    return memory * 3 // 4


def _trees_at_once(spark: SparkSession, n: int, features: Sequence[str], trees: int, fits: int) -> int:
    """How many trees of a forest have room for their row counts in memory, with so many fits at the same time."""
    room = _room(spark) // fits // max(n, 1) - _row_bytes(features, 0)
    return min(trees, max(room // 4, LEAST_TREES))


def _fits_at_once(spark: SparkSession, n: int, features: Sequence[str], fits: int) -> int:
    """How many boosting fits have room for their rows in memory: each keeps its own, and reads them in every scan."""
    return max(1, min(fits, _room(spark) // (max(n, 1) * (_row_bytes(features, 1) + BOOSTING_BYTES))))


def _trees_in_driver(spark: SparkSession, n: int, depth: int, forests: int) -> int:
    """How many trees of so many forests at the same time have room for their nodes in half of the driver's memory."""
    nodes = min(2 ** (depth + 1), 2 * max(n, 1))
    return max(spark._jvm.java.lang.Runtime.getRuntime().maxMemory() // (2 * forests * nodes * NODE_BYTES), 1)


def _deep(estimator: RandomForestRegressor, n: int) -> bool:
    """Whether the trees may have more nodes than the table has rows."""
    return estimator.getMaxDepth() > SHALLOW and 2 ** estimator.getMaxDepth() > n


def _statistics_mb(spark: SparkSession) -> int:
    """Memory of a task for node statistics: Spark's 256 MB, or less where all slots together have no room for that."""
    return max(16, min(256, _room(spark) // (4 * spark.sparkContext.defaultParallelism) >> 20))


def _part_sizes(sizes: Sequence[int], most: int) -> list[int]:
    """Trees of the parts that a forest is grown in: each of the sizes ends a part, none has more trees than ``most``."""
    parts, before = [], 0
    for size in sorted(sizes):
        more, count = size - before, -(-(size - before) // most)
        parts += [more * (i + 1) // count - more * i // count for i in range(count)]
        before = size
    return parts


def _seeds(estimator: RandomForestRegressor, count: int) -> list[int]:
    """A seed for each part of a forest; the first part has the forest's own."""
    rng = random.Random(estimator.getSeed())
    return [estimator.getSeed(), *(rng.randrange(1 << 31) for _ in range(count - 1))]


def _gathered(estimator: RandomForestRegressor, vectors: DataFrame) -> DataFrame:
    """The same rows in the same partitions, each partition in the order of the leaves of a single tree.

    The trees of a forest resemble each other: rows of one leaf of the first mostly share their nodes in the others too.
    Every scan adds each row to the statistics of its node in every tree, which are larger than the processor's cache;
    in this order the next row finds them there. Over boosting, which grows one tree at a time, nothing is gained by it.
    """
    label = estimator.getLabelCol()
    first = DecisionTreeRegressor(
        featuresCol="features", labelCol=label, predictionCol="_mean", leafCol="_leaf",
        maxDepth=min(estimator.getMaxDepth(), GATHERED_DEPTH), seed=estimator.getSeed(),
    ).fit(vectors)
    return first.transform(vectors).sortWithinPartitions("_leaf").select("features", label)


def _grow(estimator, vectors: DataFrame, n: int, features: Sequence[str], fits: int = 1):
    """Fit the trees. Spark keeps a row count per tree with every row: a forest whose counts have no room in memory is
    grown in parts that have, each from its own seed, instead of reading spilled rows in every scan."""
    if not isinstance(estimator, RandomForestRegressor):
        return estimator.fit(vectors)
    trees = estimator.getNumTrees()
    if n >= GATHERED_ROWS and trees >= LEAST_TREES:
        vectors = _gathered(estimator, vectors)
    most = _trees_at_once(vectors.sparkSession, n, features, trees, fits)
    count = -(-trees // most)
    if count == 1:
        return estimator.fit(vectors)
    grown = [
        estimator.copy({estimator.numTrees: size, estimator.seed: seed}).fit(vectors)
        for size, seed in zip(_part_sizes([trees], most), _seeds(estimator, count), strict=True)
    ]
    return joined_trees(grown)


def _fit(estimator, df: DataFrame, features: Sequence[str], label: str, scale: bool) -> PipelineModel:
    rows = _labelled(df, features, label)
    preparation = Pipeline(stages=_preparation(features, scale)).fit(rows)
    ensure_checkpoint_dir(df.sparkSession)  # boosting cuts its lineage there every few rounds
    trees = estimator.getNumTrees() if isinstance(estimator, RandomForestRegressor) else 1
    vectors, n = _vectors(preparation, rows, label, _row_bytes(features, trees))
    return PipelineModel([*preparation.stages, _grow(estimator, vectors, n, features)])


def _labelled(df: DataFrame, features: Sequence[str], label: str, *others: str) -> DataFrame:
    """Only the columns a fit reads, without the rows that have no label."""
    columns = dict.fromkeys((*features, *others))
    return df.select(*[c for c in columns if c != label], F.col(label).cast("double").alias(label)).dropna(subset=[label])


def random_forest(
    label: str, num_trees: int = 100, max_depth: int = 7, feature_subset: str = "auto", seed: int = 1,
    prediction: str = "prediction", bootstrap: bool = True,
) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features", labelCol=label, predictionCol=prediction, numTrees=num_trees,
        maxDepth=_depth(max_depth), featureSubsetStrategy=_subset(feature_subset), seed=seed, bootstrap=bootstrap,
    )


def boosted_trees(
    label: str, num_trees: int = 100, max_depth: int = 10, feature_subset: str = "sqrt", seed: int = 1,
    step_size: float = 0.1, subsample: float = 1.0, prediction: str = "prediction",
) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="features", labelCol=label, predictionCol=prediction, maxIter=num_trees,
        maxDepth=_depth(max_depth), featureSubsetStrategy=_subset(feature_subset), stepSize=step_size,
        subsamplingRate=subsample, seed=seed,
    )


def fit_random_forest(
    df: DataFrame, features: Sequence[str], label: str, num_trees: int = 100, max_depth: int = 7,
    feature_subset: str = "auto", seed: int = 1, scale: bool = True, prediction: str = "prediction",
    bootstrap: bool = True,
) -> PipelineModel:
    """Random forest regression; for two targets fit one model each. ``bootstrap=False``: every tree sees all rows."""
    estimator = random_forest(label, num_trees, max_depth, feature_subset, seed, prediction, bootstrap)
    return _fit(estimator, df, features, label, scale)


def fit_boosted_trees(
    df: DataFrame, features: Sequence[str], label: str, max_iter: int = 200, max_depth: int = 10,
    feature_subset: str = "sqrt", seed: int = 1, scale: bool = True, prediction: str = "prediction",
) -> PipelineModel:
    estimator = boosted_trees(label, max_iter, max_depth, feature_subset, seed, prediction=prediction)
    return _fit(estimator, df, features, label, scale)


def fit_boosted_trees_sub(
    df: DataFrame, features: Sequence[str], label: str, max_iter: int = 200, max_depth: int = 7, step: float = 0.005,
    subsample: float = 0.75, seed: int = 42, scale: bool = False, prediction: str = "prediction",
) -> PipelineModel:
    """Slow boosting on a row sample per tree; the column sample per tree becomes one per node, three quarters large."""
    estimator = boosted_trees(label, max_iter, max_depth, "0.75", seed, step, subsample, prediction)
    return _fit(estimator, df, features, label, scale)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The rows with their prediction; all their own columns stay as they are."""
    scored = model.transform(df)
    inputs = [c for c in scored.columns if c.startswith(INPUT_PREFIX) and c not in df.columns]
    return scored.drop(*VECTORS, *inputs)


def expand_grid(grid: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    return [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]


def random_grid(space: Mapping[str, Sequence[Any]], points: int = 32, seed: int = 99) -> list[dict[str, Any]]:
    """Distinct seeded points of a search space; the whole space when it has no more."""
    everything = expand_grid(space)
    return everything if len(everything) <= points else random.Random(seed).sample(everything, points)


BUILDERS = {"random_forest": random_forest, "boosted_trees": boosted_trees}


DEFAULT_TREES = 100  # of both builders


def grid_search(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str,
    candidates: Sequence[Mapping[str, Any]],
    model: str = "random_forest",
    dataset: str = "all",
    seed: int = 1,
    parallelism: int = 4,
    scale: bool = True,
    folder: str | None = None,
) -> tuple[SavedModels, list[dict[str, Any]]]:
    """Measure every candidate on the test rows; returns the models and, in the same order, one run record each.

    Candidates that differ in the number of trees only are nested: the largest is fitted, and the others are its first
    trees, measured in the same pass. Fits are saved in ``folder`` (by default in the shared folder) as they finish, so
    the driver holds at most ``parallelism`` of them; the returned models are loaded when asked for. Preparation is fitted
    once, and the prepared rows are written once for all fits. A forest that is deep, or whose nodes have no room in
    the driver, is grown, saved and measured in parts.
    """
    spark = train.sparkSession
    place = folder or stage_path(spark, "search")
    fitted_on = _labelled(train, features, label)
    preparation = Pipeline(stages=_preparation(features, scale)).fit(fitted_on)
    ensure_checkpoint_dir(spark)
    groups = nested_groups(candidates, DEFAULT_TREES)
    fits, slots = min(parallelism, max(len(groups), 1)), spark.sparkContext.defaultParallelism
    most = max((settings["num_trees"] for settings, _ in groups), default=1) if model == "random_forest" else 1
    row_bytes = _row_bytes(features, most)
    dealt, n_rows = _vectors(preparation, fitted_on, label, row_bytes)
    vectors = _staged(dealt, n_rows, row_bytes)
    unseen = stage_table(_vectors(preparation, _labelled(test, features, label), label)[0])

    def save(ensemble, path: str) -> None:
        PipelineModel([*preparation.stages, ensemble]).write().overwrite().save(path)

    def by_parts(estimator, sizes: Sequence[int], path: str):
        """Metrics of a forest that is deep or too large for the driver, and where the parts of each size are."""
        deep = _deep(estimator, n_rows)
        if deep:
            estimator = estimator.copy({estimator.maxMemoryInMB: _statistics_mb(spark)})
        few = max(1, -(-n_rows * row_bytes // TASK_BYTES))
        # every partition adds the statistics of all nodes, which in deep trees outnumber its rows: so few partitions, and
        # several parts at once
        rows = vectors.coalesce(few) if deep else vectors
        together = max(1, slots // (fits * few)) if deep else 1
        trees = _part_sizes(sizes, _trees_in_driver(spark, n_rows, estimator.getMaxDepth(), fits * together))
        tasks = list(enumerate(zip(trees, _seeds(estimator, len(trees)), strict=True)))

        def grow(task):
            i, (n, own) = task
            part = _grow(estimator.copy({estimator.numTrees: n, estimator.seed: own}), rows, n_rows, features, fits * together)
            save(part, f"{path}/{i}")
            return part

        def grown():
            with ThreadPool(together) as pool:
                for i in range(0, len(tasks), together):
                    yield from pool.map(grow, tasks[i : i + together], chunksize=1)

        metrics = summed_metrics(grown(), sizes, unseen, label)
        ends = [sum(trees[: i + 1]) for i in range(len(trees))]
        return metrics, {n: tuple(f"{path}/{i}" for i in range(ends.index(n) + 1)) for n in sizes}

    def fit(numbered: tuple[int, tuple[dict[str, Any], dict[int, int]]]):
        number, (settings, sizes) = numbered
        estimator = BUILDERS[model](label, seed=seed, **settings)
        path, wanted = f"{place.rstrip('/')}/{number}", sorted(set(sizes.values()))
        forest = model == "random_forest"
        if forest and (_deep(estimator, n_rows) or wanted[-1] > _trees_in_driver(spark, n_rows, estimator.getMaxDepth(), fits)):
            metrics, paths = by_parts(estimator, wanted, path)
        else:
            ensemble = _grow(estimator, vectors, n_rows, features, fits)
            save(ensemble, path)
            metrics, paths = prefix_metrics(ensemble, wanted, unseen, label), dict.fromkeys(wanted, (path,))
        about = {
            "model": model, "dataset": dataset, "target": label, "max_depth": estimator.getOrDefault("maxDepth"),
            "feature_subset": settings.get("feature_subset", estimator.getOrDefault("featureSubsetStrategy")),
            "step_size": float(estimator.getOrDefault("stepSize")) if model == "boosted_trees" else None,
            "subsample": float(estimator.getOrDefault("subsamplingRate")),
        }
        return {
            i: (SavedEnsemble(paths[n], n), {**about, "num_trees": n, **{m: metrics.get(n, {}).get(m) for m in METRICS}})
            for i, n in sizes.items()
        }

    at_once = _fits_at_once(spark, n_rows, features, fits) if model == "boosted_trees" else fits
    with ThreadPool(at_once) as pool:
        done = pool.map(fit, list(enumerate(groups)), chunksize=1)
    found = {i: pair for group in done for i, pair in group.items()}
    ordered = [found[i] for i in range(len(candidates))]
    return SavedModels([saved for saved, _ in ordered]), [run for _, run in ordered]


class Folds:
    """Rows cut into folds by a hash of their key, prepared for any number of candidates.

    The vectors of all rows are written once, dealt over the task slots; every fold reads them from there, without another
    copy or shuffle, and scales them by its own training rows. ``drop`` removes them.

    ``ahead`` names numbers of trees that will all be asked for: boosting then grows the largest at the first of them,
    measures all in the same pass and answers later calls from these errors, which are those of the smaller fits.
    """

    def __init__(
        self, df: DataFrame, features: Sequence[str], label: str, key: ColumnLike, model: str, folds: int, seed: int,
        parallelism: int, scale: bool, ahead: Sequence[int] = (),
    ):
        self.features, self.label, self.model, self.seed, self.parallelism = features, label, model, seed, parallelism
        self.ahead = tuple(ahead) if model == "boosted_trees" else ()  # a forest's rows are drawn by its size
        self.errors: dict[tuple, list[float]] = {}
        ensure_checkpoint_dir(df.sparkSession)
        fill, assemble, *scalers = _preparation(features, scale)
        labelled = _labelled(hash_folds(df, key, folds, seed), features, label, "fold")
        vectors = assemble.transform(fill.transform(labelled)).select(assemble.getOutputCol(), label, "fold")
        used, n = _used(labelled)
        wanted = _n_parts(df.sparkSession, n, _row_bytes(features, 1))
        self.spark, self.path = df.sparkSession, stage_path(df.sparkSession, "folds")
        rows = stage_table(vectors if used == wanted else vectors.repartition(wanted), self.path)
        sizes = {r["fold"]: r["count"] for r in rows.groupBy("fold").count().collect()}  # one row per fold
        self.parts = []
        for fold in range(folds):
            mine, others = rows.where(F.col("fold") == fold), rows.where(F.col("fold") != fold)
            for scaler in scalers:
                scaled = scaler.fit(others)
                mine, others = scaled.transform(mine), scaled.transform(others)
            self.parts.append((others.select("features", label), n - sizes.get(fold, 0), mine.select("features", label)))

    def drop(self) -> None:
        drop_stage(self.spark, self.path)

    def _at_once(self, fits: int) -> int:
        fits = min(self.parallelism, max(fits, 1))
        if self.model != "boosted_trees" or not self.parts:
            return fits
        return _fits_at_once(self.spark, max(n for _, n, _ in self.parts), self.features, fits)

    def rmse(self, candidates: Sequence[Mapping[str, Any]]) -> list[float]:
        """Mean error of each candidate over the folds that have rows. Nested candidates share a fit per fold."""
        def name(settings: Mapping[str, Any]) -> tuple:
            return tuple(sorted((k, v) for k, v in settings.items() if k != "num_trees"))

        def fit(task) -> dict[int, float]:
            (train, n_rows, test), settings, sizes = task
            estimator = BUILDERS[self.model](self.label, seed=self.seed, **settings)
            ensemble = _grow(estimator, train, n_rows, self.features, self.parallelism)
            metrics = prefix_metrics(ensemble, sizes, test, self.label)
            return {n: metrics[n]["rmse"] for n in sizes if n in metrics}

        tasks = []
        for settings, asked in nested_groups(candidates, DEFAULT_TREES):
            sizes = sorted({*asked.values(), *self.ahead})
            if self.ahead and all((name(settings), n) in self.errors for n in sizes):
                continue
            self.errors.update({(name(settings), n): [] for n in sizes})
            tasks += [(part, {**settings, "num_trees": sizes[-1]}, sizes) for part in self.parts]
        with ThreadPool(self._at_once(len(tasks))) as pool:
            done = pool.map(fit, tasks, chunksize=1)
        for (_part, settings, _sizes), found in zip(tasks, done, strict=True):
            for n, error in found.items():
                self.errors[name(settings), n].append(error)
        measured = [self.errors[name(c), c.get("num_trees", DEFAULT_TREES)] for c in candidates]
        return [sum(e) / len(e) if e else float("nan") for e in measured]


@dataclass(frozen=True)
class Validated:
    """Settings that were measured, their mean errors over the folds, the best of them and a model of it on all rows."""

    candidates: list[dict[str, Any]]
    avgMetrics: list[float]  # named as in Spark's own cross validation
    best: dict[str, Any]
    bestModel: PipelineModel


def _best(candidates: Sequence[Mapping[str, Any]], errors: Sequence[float]) -> dict[str, Any]:
    known = [(e, i) for i, e in enumerate(errors) if e == e]
    if not known:
        raise ValueError("no candidate could be measured")
    return dict(candidates[min(known)[1]])


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    candidates: Sequence[Mapping[str, Any]],
    key: ColumnLike,
    model: str = "boosted_trees",
    folds: int = 5,
    seed: int = 42,
    parallelism: int = 4,
    scale: bool = True,
) -> Validated:
    """K-fold search for the smallest RMSE with folds fixed by a hash of the key; holds the best settings refitted."""
    prepared = Folds(df, features, label, key, model, folds, seed, parallelism, scale)
    errors = prepared.rmse(candidates)
    prepared.drop()
    best = _best(candidates, errors)
    refitted = _fit(BUILDERS[model](label, seed=seed, **best), df, features, label, scale)
    return Validated([dict(c) for c in candidates], errors, best, refitted)


def parzen_points(
    space: Mapping[str, Sequence[Any]], tried: Sequence[tuple[Mapping[str, Any], float]], n: int, rng: random.Random,
    good: float = 0.25, draws: int = 64,
) -> list[dict[str, Any]]:
    """Up to ``n`` untried points of a search space, chosen by a tree of Parzen estimators.

    The best quarter of the tried points and the rest each give a density per dimension: every point weighs its own value
    fully and neighbours in the listed order by halves, over a flat prior. Points are drawn from the first density and
    ranked by the ratio of both; untried points drawn at random fill up what is missing.
    """
    def name(point: Mapping[str, Any]) -> tuple:
        return tuple(point[k] for k in space)

    seen = {name(p) for p, _ in tried}
    ranked = sorted((t for t in tried if t[1] == t[1]), key=lambda t: t[1])
    n_good = max(1, round(good * len(ranked)))

    def density(points: Sequence[Mapping[str, Any]]) -> dict[str, list[float]]:
        out = {}
        for k, values in space.items():
            places = [list(values).index(p[k]) for p in points]
            weights = [1.0 + sum(0.5 ** abs(i - j) for j in places) for i in range(len(values))]
            out[k] = [w / sum(weights) for w in weights]
        return out

    chosen: dict[tuple, dict[str, Any]] = {}
    if ranked:
        inner, outer = density([p for p, _ in ranked[:n_good]]), density([p for p, _ in ranked[n_good:]])
        drawn = {}
        for _ in range(draws):
            at = {k: rng.choices(range(len(values)), inner[k])[0] for k, values in space.items()}
            point = {k: space[k][i] for k, i in at.items()}
            drawn[name(point)] = (prod(inner[k][i] / outer[k][i] for k, i in at.items()), point)
        for who, (_, point) in sorted(drawn.items(), key=lambda d: -d[1][0]):
            if who not in seen and len(chosen) < n:
                chosen[who] = point
    if len(chosen) < n:
        rest = [p for p in expand_grid(space) if name(p) not in seen and name(p) not in chosen]
        for point in rng.sample(rest, min(n - len(chosen), len(rest))):
            chosen[name(point)] = point
    return list(chosen.values())


def sequential_search(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    space: Mapping[str, Sequence[Any]],
    key: ColumnLike,
    points: int = 32,
    model: str = "boosted_trees",
    folds: int = 5,
    seed: int = 99,
    parallelism: int = 4,
    scale: bool = True,
    startup: int = 5,
) -> Validated:
    """Model-based search: batches of ``parallelism`` points, each chosen by what all earlier ones showed.

    The first ``startup`` points are drawn at random. Every point is validated over the same folds; the smaller numbers
    of trees of the space come along as the first trees of its fit and count as tried, but not towards ``points``. Ends
    after ``points`` points or when the space is exhausted. The same seed tries the same points.
    """
    rng = random.Random(seed)
    ahead = space.get("num_trees", ()) if len(expand_grid(space)) <= points else ()  # else some may never be asked for
    prepared = Folds(df, features, label, key, model, folds, seed, parallelism, scale, ahead)
    tried: list[tuple[dict[str, Any], float]] = []
    asked = 0
    while asked < points:
        batch = parzen_points(space, tried, min(parallelism if tried else startup, points - asked), rng)
        if not batch:
            break
        asked += len(batch)
        known = [p for p, _ in tried]
        measured: list[dict[str, Any]] = []
        for point in batch:
            sizes = [n for n in space.get("num_trees", ()) if n <= point["num_trees"]]
            for more in [{**point, "num_trees": n} for n in sizes] or [point]:
                if more not in known and more not in measured:
                    measured.append(more)
        tried += list(zip(measured, prepared.rmse(measured), strict=True))
    prepared.drop()
    best = _best([p for p, _ in tried], [e for _, e in tried])
    refitted = _fit(BUILDERS[model](label, seed=seed, **best), df, features, label, scale)
    return Validated([p for p, _ in tried], [e for _, e in tried], best, refitted)


def runs_table(spark: SparkSession, runs: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Run records as a table whose id depends on the parameters only."""
    columns = (*RUN_COLUMNS, *METRICS)
    table = spark.createDataFrame([tuple(r.get(c) for c in columns) for r in runs], RUN_SCHEMA)
    return table.select(run_id(*RUN_COLUMNS).alias("run_id"), *columns)


def log_runs(spark: SparkSession, runs: Sequence[Mapping[str, Any]], path: str) -> DataFrame:
    """Put run records into the log and return the whole log. A run with the same parameters replaces its record.

    The log is partitioned by run_id and only the partitions of the given runs are overwritten, so a repeated job logs
    nothing twice. Frames that earlier calls returned do not see the new files; read the log anew.
    """
    table = runs_table(spark, runs)
    writer = table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_id").parquet(path)
    # with a given schema an id of digits alone stays a string
    return spark.read.schema(table.schema).parquet(path).select(*table.columns)


def best_run(runs: DataFrame, metric: str = "rmse", smallest: bool = True) -> DataFrame:
    """The run with the best metric; the smaller id wins a tie, unknown values never win."""
    order = F.col(metric).asc() if smallest else F.col(metric).desc()
    return runs.where(null_nan(F.col(metric)).isNotNull()).orderBy(order, "run_id").limit(1)


def _named(model: PipelineModel, output: str) -> PipelineModel:
    """The same model with another prediction column; the given one keeps its own."""
    return PipelineModel([*model.stages[:-1], model.stages[-1].copy().setPredictionCol(output)])


def select_and_save(
    spark: SparkSession,
    runs: Sequence[Mapping[str, Any]],
    models: Sequence[PipelineModel],
    path: str,
    airport: str,
    target: str,
    metric: str = "rmse",
) -> tuple[str, str]:
    """Save the model of the best run under ``{airport}_model_{target}_{run id}``; returns its name and path."""
    logged = runs_table(spark, runs)
    winner = best_run(logged, metric).first()
    ids = [r["run_id"] for r in logged.select("run_id").collect()]  # one per candidate
    name = f"{airport}_model_{target}_{winner['run_id']}"
    model = models[ids.index(winner["run_id"])]
    saved = f"{path.rstrip('/')}/{name}"
    _named(model, "prediction").write().overwrite().save(saved)
    return name, saved


def score(model_path: str, df: DataFrame, output: str = "prediction") -> DataFrame:
    """Predictions of a saved model, next to the rows' own columns."""
    return predict(_named(PipelineModel.load(model_path), output), df)


def compare_models(
    production: PipelineModel, staging: PipelineModel, df: DataFrame, label: str, keys: Sequence[str]
) -> DataFrame:
    """Actual value, production prediction and staged prediction side by side."""
    out = df
    for model, name in ((production, "prod_prediction"), (staging, "stage_prediction")):
        out = predict(_named(model, name), out)
    return out.select(*keys, F.col(label).alias("actual"), "prod_prediction", "stage_prediction")


STAGES = ("None", "Staging", "Production")
STAGE_LOG = "run_id string, stage string, description string, version int"


def promote(
    spark: SparkSession, run: str, stage: str, description: str, path: str, version: int | None = None
) -> DataFrame:
    """Append a stage change to the stage log and return the current stage of every run.

    Versions count up, so that the latest change of a run is well defined. A version belongs to the writer that creates
    its claim file first; another one that works at the same time takes the next number. A writer that fails after its
    claim leaves a gap. A given ``version`` that is taken raises ``FileExistsError``.
    """
    if stage not in STAGES:
        raise ValueError(f"stage {stage!r} is none of {STAGES}")
    if version is None:
        version = _last_version(spark, path) + 1
        while not create_exclusively(spark, _claim(path, version)):
            version += 1
    elif not create_exclusively(spark, _claim(path, version)):
        raise FileExistsError(f"version {version} of {path} is taken")
    row = spark.createDataFrame([(run, stage, description, version)], STAGE_LOG)
    # a folder per change: writers of one folder would remove each other's unfinished files
    row.coalesce(1).write.parquet(f"{path.rstrip('/')}/change-{version}")
    return model_stages(_stage_log(spark, path))


def _claim(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/_versions/{version}"  # scans skip names that start with an underscore


def _stage_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STAGE_LOG).option("recursiveFileLookup", True).parquet(path)


def _last_version(spark: SparkSession, path: str) -> int:
    try:
        log = _stage_log(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise
    return log.agg(F.max("version")).first()[0] or 0


def model_stages(log: DataFrame) -> DataFrame:
    """Latest stage per run."""
    latest = F.max_by(F.struct("stage", "description", "version"), "version").alias("latest")
    return log.groupBy("run_id").agg(latest).select("run_id", "latest.*")


def staged_error(model: PipelineModel, df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Mean squared error on the given rows after each boosting iteration."""
    boosted = model.stages[-1]
    vectors = PipelineModel(model.stages[:-1]).transform(_labelled(df, features, label))
    errors = boosted.evaluateEachIteration(vectors.select("features", label), "squared")
    rows = [(i + 1, float(e)) for i, e in enumerate(errors)]  # one row per tree
    return df.sparkSession.createDataFrame(rows, "iteration int, mse double")
