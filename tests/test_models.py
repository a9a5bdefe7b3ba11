"""Model jobs on a table with signal."""

import random
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ontime.operators import models as m
from ontime.operators.aggregates import regression_metrics
from ontime.operators.ensembles import first_trees
from ontime.operators.regularized import fit_regularized_trees
from ontime.sources import sinks

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(8)
    rows = []
    for i in range(800):
        a, b = rng.uniform(-5, 5), rng.choice([0.0, 1.0, None])
        rows.append((i, a, b, str(rng.randint(1, 9)), 3 * a + 4 * (b or 0) + rng.gauss(0, 0.5)))
    frame = spark.createDataFrame(rows, "id int, a double, b double, c string, y double")
    return sinks.stage_table(frame.withColumn("y", F.when(F.col("id") != 7, F.col("y"))))


@pytest.fixture(scope="module")
def parts(data):
    return m.split_train_test(data, "id")


def rmse(model, df):
    return regression_metrics(m.predict(model, df), "y", "prediction").first()["rmse"]


def test_split_is_disjoint_complete_and_stable(data, parts):
    train, test = ({r["id"] for r in part.collect()} for part in parts)
    assert not train & test and len(train | test) == 800 and 0.65 < len(train) / 800 < 0.85
    again = {r["id"] for r in m.split_train_test(data.repartition(5), "id")[0].collect()}
    assert again == train
    assert {r["id"] for r in m.split_train_test(data, "id", seed=1)[0].collect()} != train


def test_models_beat_the_mean_and_repeat(parts):
    train, test = parts
    baseline = test.select(F.stddev_pop("y")).first()[0]
    forest = m.fit_random_forest(train, FEATURES, "y", 5, 5)
    boosted = m.fit_boosted_trees(train, FEATURES, "y", 8, 3, "auto")
    slow = m.fit_boosted_trees_sub(train, FEATURES, "y", 8, 3, step=0.3)
    for model in (forest, boosted, slow):
        assert rmse(model, test) < 0.7 * baseline
    assert rmse(m.fit_random_forest(train, FEATURES, "y", 5, 5), test) == pytest.approx(rmse(forest, test))
    errors = m.staged_error(boosted, test, FEATURES, "y").orderBy("iteration").collect()
    assert len(errors) == 8 and errors[-1]["mse"] < errors[0]["mse"]
    assert errors[-1]["mse"] == pytest.approx(rmse(boosted, test) ** 2)


def test_predict_keeps_the_rows_own_columns(parts, data):
    model = m.fit_random_forest(parts[0], FEATURES, "y", 2, 2)
    scored = m.predict(model, data)
    assert scored.columns == [*data.columns, "prediction"]
    assert scored.count() == 800 and scored.where("b is null").count() == data.where("b is null").count()


def test_depth_limit():
    with pytest.raises(ValueError, match="tree depth 31"):
        m.random_forest("y", max_depth=31)
    assert m.random_forest("y", max_depth=25, feature_subset="auto").getFeatureSubsetStrategy() == "all"


def test_random_grid():
    space = {"num_trees": (1, 2, 3), "max_depth": (1, 2)}
    assert len(m.random_grid(space, 32)) == 6
    some = m.random_grid(space, 4, seed=1)
    assert len({tuple(p.items()) for p in some}) == 4 and some == m.random_grid(space, 4, seed=1)


def test_search_log_select_score_compare_promote(spark, parts):
    train, test = parts
    candidates = [{"num_trees": 1, "max_depth": 1}, {"num_trees": 5, "max_depth": 5}]
    fitted, runs = m.grid_search(train, test, FEATURES, "y", candidates)
    folder = sinks.stage_path(spark, "models")
    log = m.log_runs(spark, runs, f"{folder}/runs")
    assert log.count() == 2 and log.select("run_id").distinct().count() == 2
    first = sorted(log.select("run_id", "rmse").collect())
    log = m.log_runs(spark, runs[1:], f"{folder}/runs")
    assert sorted(log.select("run_id", "rmse").collect()) == first
    best = m.best_run(log).first()
    assert best["max_depth"] == 5 and best["rmse"] == pytest.approx(rmse_of(fitted[1], test))
    name, path = m.select_and_save(spark, runs, fitted, folder, "SFO", "arr")
    assert name == f"SFO_model_arr_{best['run_id']}"
    scored = m.score(path, test, "arr_pred")
    direct = {r["id"]: r["prediction"] for r in m.predict(PipelineModel.load(path), test).collect()}
    assert {r["id"]: r["arr_pred"] for r in scored.collect()} == direct
    production = m.fit_random_forest(train, FEATURES, "y", 1, 1)
    pair = m.compare_models(production, PipelineModel.load(path), test, "y", ["id"])
    assert pair.columns == ["id", "actual", "prod_prediction", "stage_prediction"] and pair.count() == test.count()

    stages = f"{folder}/stages"
    m.promote(spark, "r1", "Staging", "first", stages)
    m.promote(spark, "r2", "Staging", "second", stages)
    current = m.promote(spark, "r1", "Production", "better", stages)
    assert {(r["run_id"], r["stage"]) for r in current.collect()} == {("r1", "Production"), ("r2", "Staging")}
    with pytest.raises(ValueError):
        m.promote(spark, "r1", "Archive", "", stages)


def test_writers_at_the_same_time_take_different_versions(spark, tmp_path):
    path = str(tmp_path / "stages")
    with ThreadPool(4) as pool:
        pool.map(lambda i: m.promote(spark, f"r{i}", "Staging", "", path), range(8))
    current = m.promote(spark, "r0", "Production", "", path)
    found = {r["run_id"]: (r["stage"], r["version"]) for r in current.collect()}
    assert len(found) == 8 and found["r0"] == ("Production", 9)
    assert sorted(v for run, (_, v) in found.items() if run != "r0") == sorted(
        {1, 2, 3, 4, 5, 6, 7, 8} - {int(v) for v in _versions_of(spark, path, "r0")}
    )
    with pytest.raises(FileExistsError):
        m.promote(spark, "r1", "None", "", path, version=4)


def _versions_of(spark, path, run):
    log = spark.read.option("recursiveFileLookup", True).parquet(path)
    return [r["version"] for r in log.where(f"run_id = '{run}'").collect()]


def rmse_of(model, test):
    model.stages[-1].setPredictionCol("prediction")
    return rmse(model, test)


def test_cross_validation_prefers_the_deeper_tree(parts):
    fitted = m.cross_validate(
        parts[0], FEATURES, "y", [{"num_trees": 3, "max_depth": 1}, {"num_trees": 3, "max_depth": 4}], "id",
        model="random_forest", folds=3,
    )
    assert fitted.avgMetrics[1] < fitted.avgMetrics[0]


def test_best_run_ignores_unknown_values(spark):
    runs = spark.createDataFrame([("a", None), ("b", 2.0), ("c", 2.0), ("d", float("nan"))], "run_id string, rmse double")
    assert m.best_run(runs).first()["run_id"] == "b"
    assert m.best_run(runs, smallest=False).first()["run_id"] == "b"


@pytest.mark.parametrize(("name", "trees", "depth", "step"), [
    ("fit_random_forest", 100, 7, None), ("fit_random_forest_departure", 100, 7, None), ("score", 200, 10, 0.1),
    ("fit_boosted_trees", 200, 10, 0.1), ("fit_boosted_trees_sub", 200, 7, 0.005),
])
def test_registered_fits_have_the_sizes_of_the_reference(spark, monkeypatch, name, trees, depth, step):
    from ontime.catalog import QUERIES

    seen = []

    def stop(estimator, *_):
        seen.append(estimator)
        raise InterruptedError

    monkeypatch.setattr(m, "_fit", stop)
    with pytest.raises(InterruptedError):
        QUERIES[name](spark, "/root/testdata/sf0.001")
    size = seen[0].getOrDefault("numTrees" if step is None else "maxIter")
    assert (size, seen[0].getOrDefault("maxDepth")) == (trees, depth)
    assert step is None or seen[0].getOrDefault("stepSize") == step


def test_first_trees_equal_the_smaller_model(parts):
    """Of boosting the smaller fit itself; of a forest the mean of the same trees."""
    train, test = parts
    for subset in ("auto", "0.5"):
        large = m.fit_boosted_trees(train, FEATURES, "y", 7, 3, subset)
        small = m.fit_boosted_trees(train, FEATURES, "y", 3, 3, subset)
        cut = PipelineModel([*large.stages[:-1], first_trees(large.stages[-1], 3)])
        assert cut.stages[-1].getNumTrees == 3 and large.stages[-1].getNumTrees == 7
        assert _predicted(cut, test) == _predicted(small, test) != _predicted(large, test)
    forest = m.fit_random_forest(train, FEATURES, "y", 6, 4)
    cut = PipelineModel([*forest.stages[:-1], first_trees(forest.stages[-1], 4)])
    vectors = PipelineModel(forest.stages[:-1]).transform(test).select("id", "features")
    trees = [dict(vectors.select("id", "features").rdd.map(lambda r: r["id"]).zip(t.transform(vectors).select("prediction").rdd.map(lambda r: r[0])).collect()) for t in cut.stages[-1].trees]
    assert len(trees) == 4
    for i, value in _predicted(cut, test).items():
        assert value == pytest.approx(sum(t[i] for t in trees) / 4)
    with pytest.raises(ValueError, match="7 of 6 trees"):
        first_trees(forest.stages[-1], 7)


def _predicted(model, df):
    return {r["id"]: r["prediction"] for r in m.predict(model, df).collect()}


@pytest.mark.parametrize("kind", ["random_forest", "boosted_trees"])
def test_nested_candidates_share_a_fit(spark, parts, monkeypatch, kind):
    train, test = parts
    sizes = []
    build = m.BUILDERS[kind]
    monkeypatch.setitem(m.BUILDERS, kind, lambda *a, **b: sizes.append(b["num_trees"]) or build(*a, **b))
    candidates = m.expand_grid({"num_trees": (2, 6, 4), "max_depth": (2, 3)})
    fitted, runs = m.grid_search(train, test, FEATURES, "y", candidates, kind)
    assert sizes == [6, 6] and len(fitted) == len(runs) == 6
    assert [(r["num_trees"], r["max_depth"]) for r in runs] == [(c["num_trees"], c["max_depth"]) for c in candidates]
    for i in (0, 3, 4):
        assert fitted[i].stages[-1].getNumTrees == candidates[i]["num_trees"]
        assert rmse(fitted[i], test) == pytest.approx(runs[i]["rmse"])
    assert m.runs_table(spark, runs).select("run_id").distinct().count() == 6
    assert len(fitted + fitted[:2]) == 8


def test_parzen_points_go_where_errors_are_small():
    space = {"num_trees": tuple(range(20)), "max_depth": (1, 2, 3, 4)}
    rng = random.Random(4)

    def error(p):
        return (p["num_trees"] - 15) ** 2 + 10 * (p["max_depth"] - 3) ** 2

    tried = [(p, error(p)) for p in m.parzen_points(space, [], 8, rng)]
    assert len(tried) == 8
    while len(tried) < 32:
        tried += [(p, error(p)) for p in m.parzen_points(space, tried, 4, rng)]
    assert len({tuple(p.items()) for p, _ in tried}) == len(tried)
    later = [e for _, e in tried[16:]]
    assert sum(later) / len(later) < sum(e for _, e in tried[:8]) / 8 and min(e for _, e in tried) <= 5
    everything = [(p, float("nan")) for p in m.expand_grid(space)]
    assert m.parzen_points(space, everything, 3, rng) == []
    assert len(m.parzen_points(space, everything[:-2], 5, rng)) == 2


def test_sequential_search_repeats_and_is_no_worse_than_the_whole_grid(parts):
    space = {"num_trees": (1, 2, 4), "max_depth": (1, 2, 3)}
    some = m.sequential_search(parts[0], FEATURES, "y", space, "id", 32, folds=2, startup=2, parallelism=2)
    again = m.sequential_search(parts[0], FEATURES, "y", space, "id", 32, folds=2, startup=2, parallelism=2)
    assert some.candidates == again.candidates and some.best == again.best
    assert some.avgMetrics == pytest.approx(again.avgMetrics)
    whole = m.cross_validate(parts[0], FEATURES, "y", m.expand_grid(space), "id", folds=2, seed=99)
    assert min(some.avgMetrics) == pytest.approx(min(whole.avgMetrics)) and some.best == whole.best
    assert some.bestModel.stages[-1].getNumTrees == some.best["num_trees"]
    one = m.sequential_search(parts[0], FEATURES, "y", space, "id", 1, folds=2)
    assert len({c["max_depth"] for c in one.candidates}) == 1


def test_model_job_takes_feature_lists_and_drops_incomplete_rows(spark, monkeypatch):
    from ontime.catalog import inputs
    from ontime.catalog.registry import PARAMS
    from ontime.plans import jobs
    from ontime.schema import SCHEDULE_FEATURES

    enriched = inputs.enriched(spark, "/root/testdata/sf0.001")
    hole = F.when(F.col("flight_id") % 3 != 0, F.col("distance"))
    enriched = sinks.stage_table(enriched.withColumn("distance", hole))
    seen = {}
    search = m.grid_search

    def spy(train, test, features, label, *rest):
        seen["features"], seen["rows"] = tuple(features), train.unionByName(test)
        return search(train, test, features, label, *rest)

    monkeypatch.setattr(m, "grid_search", spy)
    folder = sinks.stage_path(spark, "job")
    sizes = [{"num_trees": n, "max_depth": 2} for n in (1, 2)]
    trained = jobs.model_job(enriched, PARAMS, "arr", {"random_forest": sizes}, folder, f"{folder}/runs", features="schedule", missing="drop")
    assert seen["features"] == SCHEDULE_FEATURES and trained.runs.count() == 2
    kept = seen["rows"]
    assert kept.count() > 0 and kept.where("flight_id % 3 = 0").count() == 0
    assert kept.dropna(subset=[*SCHEDULE_FEATURES, "arr_delay"]).count() == kept.count()
    jobs.model_job(enriched, PARAMS, "dep", {"random_forest": sizes[:1]}, folder, f"{folder}/runs", features=("distance",))
    assert seen["features"] == ("distance",) and seen["rows"].where("distance is null").count() > 0
    with pytest.raises(ValueError, match="missing is"):
        jobs.model_job(enriched, PARAMS, "arr", {}, folder, folder, missing="mean")


def test_regularized_trees(parts):
    train, test = parts
    plain = m.fit_boosted_trees(train, FEATURES, "y", 1, 3, "auto", scale=False)
    whole = {"step": 1.0, "subsample": 1.0, "column_share": 1.0}
    same = fit_regularized_trees(train, FEATURES, "y", 1, 3, penalty=0.0, **whole).transform(test)
    expected = {r["id"]: r["prediction"] for r in m.predict(plain, test).collect()}
    assert {r["id"]: r["prediction"] for r in same.collect()} == pytest.approx(expected)
    assert same.columns == [*test.columns, "prediction"]

    slow = {"step": 0.3, "subsample": 0.75, "column_share": 0.7, "seed": 3}
    model = fit_regularized_trees(train, FEATURES, "y", 12, 3, **slow)
    errors = regression_metrics(model.transform(test), "y", "prediction").first()
    assert errors["rmse"] < 0.7 * test.select(F.stddev_pop("y")).first()[0]
    assert {len(s.features) for s in model.steps} == {2} and len({tuple(s.features) for s in model.steps}) > 1
    again = fit_regularized_trees(train, FEATURES, "y", 12, 3, **slow)
    assert [s.values for s in again.steps] == [pytest.approx(s.values) for s in model.steps]

    heavy = fit_regularized_trees(train, FEATURES, "y", 2, 3, penalty=1e9, **whole)
    assert all(abs(v) < 1e-4 for s in heavy.steps for v in s.values)
    blunt = fit_regularized_trees(train, FEATURES, "y", 2, 3, least_gain=1e9, **whole)
    assert all(len(s.values) == 1 for s in blunt.steps)
    empty = fit_regularized_trees(train.where("y is null"), FEATURES, "y", 2, 3)
    assert empty.steps == [] and {r["prediction"] for r in empty.transform(test).collect()} == {0.0}


def test_fits_deal_their_rows_by_slots_and_bytes(parts, monkeypatch):
    rows = m._labelled(parts[0].repartition(11), FEATURES, "y")
    slots = rows.sparkSession.sparkContext.defaultParallelism
    preparation = m.Pipeline(stages=m._preparation(FEATURES, True)).fit(rows)
    dealt, n = m._vectors(preparation, rows, "y")
    assert n == rows.count() == dealt.count() and dealt.rdd.getNumPartitions() == slots
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 1.3 * n / slots
    monkeypatch.setattr(m, "TASK_BYTES", n * m._row_bytes(FEATURES, 100) // (3 * slots))
    many, _ = m._vectors(preparation, rows, "y", m._row_bytes(FEATURES, 100))
    assert many.rdd.getNumPartitions() % slots == 0 and many.rdd.getNumPartitions() >= 3 * slots
    staged = m._staged(many, n, m._row_bytes(FEATURES, 100))
    assert staged.count() == n and staged.rdd.getNumPartitions() == many.rdd.getNumPartitions()


def test_a_forest_beyond_memory_is_grown_in_parts(spark, parts, monkeypatch):
    train, test = parts
    whole = m.fit_random_forest(train, FEATURES, "y", 5, 4)
    asked = []
    monkeypatch.setattr(m, "_trees_at_once", lambda *a: asked.append(a) or 2)
    grown = m.fit_random_forest(train, FEATURES, "y", 5, 4)
    forest = grown.stages[-1]
    assert asked[0][1] == train.where("y is not null").count() and asked[0][3] == 5
    assert forest.getNumTrees == len(forest.trees) == 5 and len({t.toDebugString for t in forest.trees}) == 5
    assert rmse(grown, test) == pytest.approx(rmse(whole, test), rel=0.3)
    first = m.fit_random_forest(train, FEATURES, "y", 1, 4).stages[-1]
    assert forest.trees[0].toDebugString.split("\n")[1:] == first.trees[0].toDebugString.split("\n")[1:]
    path = sinks.stage_path(spark, "forest")
    grown.write().save(path)
    assert _predicted(PipelineModel.load(path), test) == _predicted(grown, test)
    _fitted, runs = m.grid_search(train, test, FEATURES, "y", m.expand_grid({"num_trees": (2, 5), "max_depth": (4,)}))
    assert [r["num_trees"] for r in runs] == [2, 5] and runs[1]["rmse"] == pytest.approx(rmse(grown, test), rel=0.3)


def test_trees_at_once_follow_the_memory(spark):
    n = [m._trees_at_once(spark, rows, FEATURES, 500, 1) for rows in (10, 2_000_000, 5_000_000, 10**12)]
    assert n[0] == 500 > n[1] > n[2] > n[3] == m.LEAST_TREES
    assert m._trees_at_once(spark, 2_000_000, FEATURES, 500, 4) < n[1]


def test_a_search_of_the_whole_space_grows_no_tree_twice(parts, monkeypatch):
    built = []
    build = m.BUILDERS["boosted_trees"]
    monkeypatch.setitem(m.BUILDERS, "boosted_trees", lambda *a, **b: built.append((b["num_trees"], b["max_depth"])) or build(*a, **b))
    space = {"num_trees": (1, 2, 4), "max_depth": (1, 2)}
    found = m.sequential_search(parts[0], FEATURES, "y", space, "id", 6, folds=2, startup=1, parallelism=1)
    assert sorted(built[:-1]) == [(4, 1)] * 2 + [(4, 2)] * 2 and built[-1] == tuple(found.best.values())
    assert sorted(map(str, found.candidates)) == sorted(map(str, m.expand_grid(space)))
    alone = m.Folds(parts[0], FEATURES, "y", "id", "boosted_trees", 2, 99, 2, True)
    for c, error in list(zip(found.candidates, found.avgMetrics))[::4]:
        assert alone.rmse([c])[0] == pytest.approx(error)


def test_forests_of_a_search_are_grown_for_the_sizes_that_are_asked(parts):
    folds = m.Folds(parts[0], FEATURES, "y", "id", "random_forest", 2, 99, 2, True, (1, 2, 4))
    plain = m.Folds(parts[0], FEATURES, "y", "id", "random_forest", 2, 99, 2, True)
    assert folds.rmse([{"num_trees": 2}]) == pytest.approx(plain.rmse([{"num_trees": 2}]))


def test_boosting_fits_at_once_follow_the_memory(spark, parts, monkeypatch):
    n = [m._fits_at_once(spark, rows, FEATURES, 4) for rows in (0, 10, 10**12)]
    assert n == [4, 4, 1]
    some = m._room(spark) // (2 * (m._row_bytes(FEATURES, 1) + m.BOOSTING_BYTES))
    assert m._fits_at_once(spark, some, FEATURES, 4) == 2
    running, most = [], []
    grow = m._grow

    def spy(*args):
        running.append(1)
        most.append(len(running))
        try:
            return grow(*args)
        finally:
            running.pop()

    monkeypatch.setattr(m, "_grow", spy)
    monkeypatch.setattr(m, "_room", lambda _: 1)
    candidates = m.expand_grid({"num_trees": (1,), "max_depth": (1, 2, 3)})
    m.grid_search(*parts, FEATURES, "y", candidates, "boosted_trees")
    m.Folds(parts[0], FEATURES, "y", "id", "boosted_trees", 2, 99, 4, True).rmse(candidates)
    assert most == [1] * 9


def test_large_forests_read_their_rows_leaf_by_leaf(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.randrange(4), i) for i in range(600)]
    frame = spark.createDataFrame([(float(a), float(i % 7), 10.0 * a) for a, i in rows], "a double, b double, y double")
    dealt, n = m._vectors(m.Pipeline(stages=m._preparation(["a", "b"], False)).fit(frame), frame, "y")
    forest = m.random_forest("y", 12, 4)

    def in_order(df):
        return [(r["_part"], r["y"], *r["features"]) for r in df.withColumn("_part", F.spark_partition_id()).collect()]

    plain, gathered = in_order(dealt), in_order(m._gathered(forest, dealt))
    assert sorted(gathered) == sorted(plain)  # the same rows, each in its own partition
    runs = [1 + sum(a[:2] != b[:2] for a, b in zip(found, found[1:])) for found in (plain, gathered)]
    assert runs[1] == len({r[:2] for r in plain}) < runs[0]

    seen = []
    whole = m._gathered
    monkeypatch.setattr(m, "_gathered", lambda *args: seen.append(args) or whole(*args))
    m.fit_random_forest(frame, ["a", "b"], "y", 12, 4)
    assert not seen  # few rows stay as they are
    monkeypatch.setattr(m, "GATHERED_ROWS", n)
    model = m.fit_random_forest(frame, ["a", "b"], "y", 12, 4)
    assert len(seen) == 1 and model.stages[-1].getNumTrees == 12
    assert m.predict(model, frame).columns == ["a", "b", "y", "prediction"] and rmse(model, frame) < 0.5
    m.fit_random_forest(frame, ["a", "b"], "y", 2, 4)
    m.fit_boosted_trees(frame, ["a", "b"], "y", 2, 2)
    assert len(seen) == 1


def test_the_registered_grid_search_has_the_whole_grid(spark, monkeypatch):
    from ontime.catalog import QUERIES
    from ontime.schema import FOREST_GRID

    seen = []

    def stop(train, test, features, label, candidates, *rest):
        seen.extend(candidates)
        raise InterruptedError

    monkeypatch.setattr(m, "grid_search", stop)
    with pytest.raises(InterruptedError):
        QUERIES["grid_search"](spark, "/root/testdata/sf0.001")
    assert len(seen) == 18 and seen == m.expand_grid(FOREST_GRID)


def test_a_forest_beyond_the_driver_is_grown_saved_and_measured_in_parts(spark, parts, monkeypatch):
    train, test = parts
    assert m._part_sizes([2, 5, 9], 3) == [2, 3, 2, 2] and m._part_sizes([4], 9) == [4]
    candidates = m.expand_grid({"num_trees": (2, 5), "max_depth": (3, 12)})
    _whole, expected = m.grid_search(train, test, FEATURES, "y", candidates)
    monkeypatch.setattr(m, "_trees_in_driver", lambda *a: 2)
    fitted, runs = m.grid_search(train, test, FEATURES, "y", candidates)
    assert [len(saved.paths) for saved in fitted.saved] == [1, 1, 3, 3]
    for i, run in enumerate(runs):
        forest = fitted[i].stages[-1]
        assert forest.getNumTrees == len(forest.trees) == candidates[i]["num_trees"] == run["num_trees"]
        assert len({t.toDebugString for t in forest.trees}) == forest.getNumTrees
        assert rmse(fitted[i], test) == pytest.approx(run["rmse"])
        assert run["rmse"] == pytest.approx(expected[i]["rmse"], rel=0.3)


def test_trees_in_the_driver_follow_its_memory(spark):
    assert not m._deep(m.random_forest("y", max_depth=10), 10) and not m._deep(m.random_forest("y", max_depth=12), 5000)
    assert m._deep(m.random_forest("y", max_depth=12), 4000) and 16 <= m._statistics_mb(spark) <= 256
    shallow, deep, more, all_rows = [
        m._trees_in_driver(spark, n, depth, fits) for n, depth, fits in ((10**6, 7, 1), (10**6, 25, 1), (10**6, 7, 4), (10**12, 30, 1))
    ]
    assert shallow > more > deep >= all_rows == 1


def test_folds_write_their_rows_once_and_read_them_without_a_shuffle(spark, parts, monkeypatch, tmp_path):
    written = []
    stage = m.stage_table
    monkeypatch.setattr(m, "stage_table", lambda *a: written.append(a) or stage(*a))
    folds = m.Folds(parts[0].repartition(11), FEATURES, "y", "id", "boosted_trees", 3, 42, 2, True)
    known = parts[0].where("y is not null").count()
    assert len(written) == 1 and sum(test.count() for _, _, test in folds.parts) == known
    for train, n, test in folds.parts:
        assert train.count() == n == known - test.count()
        assert "Exchange" not in train._jdf.queryExecution().executedPlan().toString()
        values = [v for r in train.collect() for v in r["features"]]
        assert min(values) == 0 and max(values) == 1  # scaled by the training rows alone
    monkeypatch.setattr(m, "stage_path", lambda *_: str(tmp_path / "folds"))
    m.cross_validate(parts[0], FEATURES, "y", [{"num_trees": 1, "max_depth": 1}], "id", folds=2)
    assert len(written) == 2 and not (tmp_path / "folds").exists()
