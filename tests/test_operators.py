"""Operators on small frames: filters, joins, windows, aggregates, sinks."""

import random
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ontime.operators import aggregates as agg
from ontime.operators import filters, joins, projections, quality
from ontime.operators.windows import previous_leg_flag
from ontime.params import run_params
from ontime.schema import ARRIVAL_FEATURES, DEPARTURE_FEATURES, ENRICHED_COLUMNS, SCHEDULE_FEATURES, SILVER_COLUMNS
from ontime.sources import scans, sinks


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_column_lists_have_their_sizes():
    assert len(SILVER_COLUMNS) == len(set(SILVER_COLUMNS)) == 46
    assert len(ENRICHED_COLUMNS) == len(set(ENRICHED_COLUMNS)) == 62
    assert (len(ARRIVAL_FEATURES), len(DEPARTURE_FEATURES), len(SCHEDULE_FEATURES)) == (24, 24, 25)


def test_run_params():
    params = run_params("SFO", "2019-01-01", "2019-02-28")
    assert params.inference == date(2019, 3, 1)
    assert run_params("XXX", "2019-01-01", date(2019, 2, 28), "2019-04-01", airports=None).inference == date(2019, 4, 1)
    with pytest.raises(ValueError, match="unknown airport"):
        run_params("XXX", "2019-01-01", "2019-02-28")
    with pytest.raises(ValueError, match="training starts"):
        run_params("SFO", "2019-03-01", "2019-02-28")


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "string"])
@pytest.mark.parametrize(
    ("closed", "days"), [("both", [2, 3, 4]), ("left", [2, 3]), ("right", [3, 4]), ("neither", [3])]
)
def test_filter_dates_means_whole_days(spark, kind, closed, days):
    hour = "" if kind in ("date", "string") else " 17:00:00"
    frame = spark.createDataFrame([(d, f"2024-01-0{d}{hour}") for d in range(1, 6)], "d int, t string")
    frame = frame.withColumn("t", F.col("t").cast(kind))
    kept = filters.filter_dates(frame, "2024-01-02", date(2024, 1, 4), closed, "t")
    assert [r[0] for r in rows(kept, "d")] == days


def test_filter_completed_drops_unknown_flags(spark):
    frame = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (3, 0, 1), (4, None, 0)], "i int, cancelled int, diverted int")
    assert rows(filters.filter_completed(frame), "i") == [(1,)]


def test_null_and_range_filters(spark):
    nan, inf = float("nan"), float("inf")
    frame = spark.createDataFrame([(1, 1.0), (2, nan), (3, None), (4, inf), (5, -inf)], "i int, x double")
    assert rows(filters.drop_any_null(frame), "i") == [(1,), (4,), (5,)]
    assert rows(filters.flag_out_of_range(frame, ["x"]), "i") == [(2,), (4,), (5,)]
    assert filters.numeric_columns(frame) == ["x"]
    filled = projections.fill_nulls(frame, {"x": 0, "absent": 1})
    assert rows(filled.where("i in (2, 3)"), "x") == [(0.0,), (0.0,)]


def test_edge_filter_rejects_other_ends(spark):
    with pytest.raises(ValueError):
        filters.filter_edges(spark.range(1), "middle", "A")


def test_scale_minmax(spark):
    frame = spark.createDataFrame([(1, 0.0, 7.0), (2, 5.0, 7.0), (3, 10.0, 7.0), (4, None, 7.0)], "i int, x double, k double")
    scaled = {r["i"]: (r["x"], r["k"]) for r in projections.scale_minmax(frame, ["x", "k"]).collect()}
    assert scaled == {1: (0.0, 0.0), 2: (0.5, 0.0), 3: (1.0, 0.0), 4: (None, 0.0)}
    other = spark.createDataFrame([(20.0, 7.0)], "x double, k double")
    assert projections.scale_minmax(other, ["x", "k"], frame).first()["x"] == 2.0


def test_split_features_labels_takes_labels_out(spark):
    frame = spark.createDataFrame([(1, 2.0, None)], "a int, y double, b double")
    row = projections.split_features_labels(frame, ["a", "b", "y"], ["y"]).first()
    assert len(row["features"]) == 2 and row["y"] == 2.0


HOURS = [datetime(2024, 1, 1, h) for h in range(3)]


@pytest.fixture(scope="module")
def weather(spark):
    cells = [(h, code, float(i)) for i, (h, code) in enumerate((h, k) for h in HOURS for k in "AB")]
    return spark.createDataFrame(cells, "time timestamp, code string, avg_temp_f double")


@pytest.mark.parametrize("salt", [1, 5])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_enrichment_with_a_hot_key(spark, weather, how, salt):
    trips = [(i, HOURS[0], "A") for i in range(200)] + [(200, HOURS[2], "B"), (201, HOURS[1], "Z"), (202, None, "A")]
    frame = spark.createDataFrame(trips, "i int, dep_time timestamp, origin string")
    joined = joins.enrich_departure(frame, weather, how, salt)
    assert joined.columns == ["i", "dep_time", "origin", "dep_avg_temp_f"]
    found = dict(rows(joined, "i", "dep_avg_temp_f")) if how == "inner" else {
        r["i"]: r["dep_avg_temp_f"] for r in joined.collect()
    }
    expected = dict.fromkeys(range(200), 0.0) | {200: 5.0}
    if how == "left":
        expected |= {201: None, 202: None}
    assert found == expected


def test_decode_codes_keeps_unknown_rows(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "i int, k string")
    dim = spark.createDataFrame([("a", "Ay")], "code string, name string")
    for names in (dim, {"a": "Ay"}):
        out = {r["i"]: r["label"] for r in joins.decode_codes(frame, "k", names, "label").collect()}
        assert out == {1: "Ay", 2: None, 3: None}


def brute_previous(trips):
    """Previous flag per key by sorting in memory."""
    last, out = {}, {}
    smallest = datetime.min
    for i, key, ts, flag in sorted(trips, key=lambda t: (t[2] is not None, t[2] or smallest, t[0])):
        out[i] = last.get(key)
        last[key] = flag
    return out


@pytest.mark.parametrize("slice_by", ["hour", "day", "month", None])
def test_previous_leg_against_brute_force(spark, slice_by):
    rng = random.Random(5)
    trips = []
    for i in range(600):
        key = rng.choice(["N1", "N1", "N1", "N2", "N3", None])  # one key holds half of the rows
        ts = None if rng.random() < 0.05 else datetime(2024, rng.randint(1, 3), rng.randint(1, 28), rng.randint(0, 23))
        trips.append((i, key, ts, rng.choice([0, 1, None])))
    frame = spark.createDataFrame(trips, "flight_id int, tail_num string, crs_dep_timestamp timestamp, arr_del15 int")
    result = previous_leg_flag(frame, slice_by=slice_by)
    assert {r["flight_id"]: r["pr_arr_del15"] for r in result.collect()} == brute_previous(trips)
    unknown = previous_leg_flag(frame, slice_by=slice_by, null_keys="null")
    expected = {i: v for i, v in brute_previous([t for t in trips if t[1]]).items()}
    expected |= {t[0]: None for t in trips if t[1] is None}
    assert {r["flight_id"]: r["pr_arr_del15"] for r in unknown.collect()} == expected


def test_correlation_skips_nan_and_is_symmetric(spark):
    nan = float("nan")
    data = [(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, nan, 5.0), (4.0, 8.0, 5.0), (None, 1.0, 5.0)]
    frame = spark.createDataFrame(data, "a double, b double, k double")
    matrix = {(r[0], r[1]): r[2] for r in agg.correlation_matrix(frame, ["a", "b", "k"]).collect()}
    assert len(matrix) == 9
    assert matrix["a", "b"] == matrix["b", "a"] == pytest.approx(0.99984, abs=1e-4)
    assert matrix["a", "a"] == matrix["b", "b"] == 1.0
    assert matrix["k", "k"] is None and matrix["a", "k"] is None


def test_correlation_by_matrix_equals_correlation_by_group(spark):
    rng = random.Random(5)
    data = []
    for i in range(4000):
        x = rng.gauss(0, 1)
        gap = None if rng.random() < 0.2 else 1e6 + x + rng.gauss(0, 2)  # a mean far from 0
        odd = float("nan") if rng.random() < 0.1 else rng.choice([0.0, x])
        data.append((x, gap, odd, 0.1, None, x if i < 2 else None, 0.3 if i % 2 else None, 0.1 * (i % 2)))
    names = ["x", "gap", "odd", "same", "none", "two", "half", "parity"]
    frame = spark.createDataFrame(data, ", ".join(f"{n} double" for n in names)).repartition(5)
    got, plain = (
        {(r[0], r[1]): r[2] for r in agg.correlation_matrix(frame, names, by_gram=way).collect()} for way in (True, False)
    )
    assert got.keys() == plain.keys() and len(got) == 64
    for pair, r in plain.items():
        # rows where "half" is known have one value of "parity"
        if {*pair} & {"same", "none", "half"}:
            assert got[pair] is None
        else:
            assert got[pair] == pytest.approx(r, abs=1e-9)
    empty = agg.correlation_matrix(frame.limit(0), names, by_gram=True).collect()
    assert len(empty) == 64 and {r[2] for r in empty} == {None}


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_top_values_by_bucket_lose_no_value(spark, buckets):
    rng = random.Random(buckets)
    values = [rng.choice(["hot", None, f"v{rng.randint(0, 30)}", f"rare{rng.randint(0, 5000)}"]) for _ in range(6000)]
    frame = spark.createDataFrame([(v,) for v in values], "v string").repartition(4)
    counts = Counter(v for v in values if v is not None)
    ordered = sorted(counts.items(), key=lambda item: (-item[1], item[0]))
    for k in (1, 20, 10_000):
        got = [tuple(r) for r in quality.top_values(frame, "v", k, buckets).collect()]
        assert got == ordered[:k]
    assert quality.top_values(frame.limit(0), "v", 3, buckets).count() == 0


def test_regression_metrics_match_the_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    rng = random.Random(1)
    data = [(y, y + rng.gauss(0, 3)) for y in (rng.uniform(-20, 60) for _ in range(300))]
    frame = spark.createDataFrame(data, "y double, p double")
    got = agg.regression_metrics(frame, "y", "p").first()
    for name in ("mse", "rmse", "mae", "r2"):
        evaluator = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name)
        assert got[name] == pytest.approx(evaluator.evaluate(frame))


def test_hash_samples_are_stable_and_nested(spark):
    frame = spark.range(5000)
    small = {r[0] for r in scans.sample_by_hash(frame, "id", 0.1).collect()}
    large = {r[0] for r in scans.sample_by_hash(frame.repartition(7), "id", 0.3).collect()}
    assert small < large and 400 < len(small) < 600
    assert scans.sample_by_hash(frame, "id", 1.0).count() == 5000
    assert scans.sample_by_hash(frame, "id", 0.0).count() == 0


def test_replace_reads_and_writes_the_same_path(spark):
    path = sinks.stage_path(spark, "self")
    first = sinks.replace_parquet(spark.range(10), path)
    again = sinks.replace_parquet(first.where("id >= 4"), path)
    assert again.count() == 6
    assert sinks.publish_table(again.where("id >= 8"), "ontime_self", path).count() == 2
    stored = sinks.replace_parquet(spark.range(4), path)
    assert sinks.replace_parquet(stored.where("id > 0"), path).count() == 3


def test_predictions_may_read_their_own_path(spark):
    path = sinks.stage_path(spark, "predictions")
    frame = spark.createDataFrame([(1, "A"), (2, "B"), (3, "B")], "i int, airport string")
    stored = sinks.publish_predictions(frame, path)
    out = sinks.publish_predictions(stored.where("i <> 2"), path)
    assert rows(out, "i", "airport") == [(1, "A"), (3, "B")]


def test_predictions_replace_one_airport_only(spark):
    path = sinks.stage_path(spark, "predictions")
    both = spark.createDataFrame([(1, "A"), (2, "B")], "i int, airport string")
    sinks.publish_predictions(both, path)
    out = sinks.publish_predictions(spark.createDataFrame([(3, "A")], "i int, airport string"), path)
    assert rows(out, "i", "airport") == [(2, "B"), (3, "A")]


def test_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        sinks.shared_dir(Session())


def test_pages_follow_the_order(spark):
    frame = spark.range(100).withColumn("x", -F.col("id"))
    assert [r["id"] for r in agg.page_rows(frame, 50, 53, ["id"]).collect()] == [50, 51, 52]
    assert [r["id"] for r in agg.top_k(frame, "x", 2).collect()] == [0, 1]


@pytest.mark.parametrize("name", ["my dir", "50%25 off", "up/../beside"])
def test_replace_parquet_may_read_its_own_path(spark, tmp_path, name):
    (tmp_path / "up").mkdir()
    path = str(tmp_path / name)
    first = sinks.replace_parquet(spark.range(10), path)
    assert sinks.replace_parquet(first.where("id >= 4"), path).count() == 6
    assert sinks.publish_table(spark.read.parquet(path).where("id >= 8"), "ontime_odd_path", path).count() == 2
    spark.sql("drop table ontime_odd_path")


def test_mean_delays_of_unlisted_carriers(spark):
    rows = spark.createDataFrame(
        [("A", "C0", 1.0), ("A", "C9", 2.0), ("A", None, 4.0), ("B", "C9", 5.0), ("B", "C8", float("nan"))],
        "origin string, op_carrier string, dep_delay_new double",
    )
    matrix = agg.mean_delay_pivot(rows, ["C0"])
    assert matrix.columns == ["origin", "C0", "other"]
    assert {tuple(r) for r in matrix.collect()} == {("A", 1.0, 3.0), ("B", None, 5.0)}
    assert {tuple(r) for r in agg.mean_delay_pivot(rows, ["C0"], other=None).collect()} == {("A", 1.0), ("B", None)}
    long = agg.mean_delay_by_carrier(rows)
    assert {tuple(r) for r in long.collect()} == {
        ("A", "C0", 1.0), ("A", "C9", 2.0), ("A", None, 4.0), ("B", "C9", 5.0), ("B", "C8", None),
    }
    with pytest.raises(ValueError):
        agg.mean_delay_pivot(rows, ["C0"], other="C0")


def test_deep_pages_follow_the_order(spark, monkeypatch):
    monkeypatch.setattr(agg, "FIRST_PAGES", 0)
    rows = [(i % 3 if i % 5 else None, i, f"part{i}") for i in range(5000)] + [(1, 7, "same")] * 40
    frame = spark.createDataFrame(rows, "key int, part int, row string").repartition(6)
    everything = agg.page_rows(frame, 0, 10_000, ["key"])
    assert everything.columns == frame.columns and sorted(map(str, everything.collect())) == sorted(map(str, frame.collect()))
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1]) if r[0] is not None else (False, 0, r[1]))
    for lo, hi in ((0, 5), (990, 1010), (2400, 2600), (5030, 5050), (6000, 7000)):
        page = [(r["key"], r["part"], r["row"]) for r in agg.page_rows(frame, lo, hi, ["key", "part", "row"]).collect()]
        assert page == sorted(ordered, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))[lo:hi]
        one_key = [r["key"] for r in agg.page_rows(frame, lo, hi, ["key"]).collect()]
        assert one_key == [r[0] for r in ordered][lo:hi]
    assert agg.page_rows(frame.limit(0), 3, 9, ["key"]).count() == 0
