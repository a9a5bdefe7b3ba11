"""Profiles, rules, validation and drift on small frames."""

import random
import statistics

import math

import pytest
from pyspark.sql import functions as F

from ontime.operators import drift
from ontime.operators import quality as q


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    data = [
        (i, rng.choice(["a", "b", "c"]), float("nan") if i % 10 == 0 else rng.gauss(0, 1), None if i % 4 else i % 3)
        for i in range(501)
    ]
    return spark.createDataFrame(data, "i long, kind string, x double, n int").withColumn("day", F.lit("2024-01-01").cast("date"))


def by_name(df):
    return {r["column_name"]: r for r in df.collect()}


def test_profile_matches_python(table):
    profile = by_name(q.column_profile(table))
    raw = [r for r in table.collect()]
    xs = [r["x"] for r in raw if r["x"] == r["x"]]
    assert set(profile) == {"i", "kind", "x", "n", "day"}
    assert profile["x"]["n_missing"] == 501 - len(xs)
    assert profile["x"]["mean"] == pytest.approx(statistics.fmean(xs))
    assert profile["x"]["stddev"] == pytest.approx(statistics.pstdev(xs))
    assert profile["x"]["median"] == statistics.median_low(xs)
    assert profile["n"]["n_zeros"] == sum(r["n"] == 0 for r in raw)
    assert (profile["kind"]["n_distinct"], profile["kind"]["avg_length"]) == (3, 1.0)
    assert (profile["day"]["kind"], profile["day"]["mean"]) == ("time", None)


def test_profile_of_nothing(table):
    empty = by_name(q.column_profile(table.limit(0)))
    assert empty["x"]["n_rows"] == 0 and empty["x"]["mean"] is None and empty["kind"]["n_distinct"] == 0


def test_approximate_distinct_is_an_option(table):
    assert by_name(q.column_profile(table, ["kind"], exact_distinct=False))["kind"]["n_distinct"] == 3


def test_a_table_meets_its_own_rules(table):
    profile = q.column_profile(table)
    rules = q.infer_expectations(profile)
    unseen = q.unseen_values(table, q.infer_domains(table, rules))
    assert q.validate_profile(profile, rules, unseen).count() == 0


def test_every_anomaly_is_found_and_environments_excuse_labels(table):
    rules = q.infer_expectations(q.column_profile(table.withColumn("label", F.lit(1.0))))
    domains = q.infer_domains(table, rules)
    odd = table.select(
        F.when(F.col("i") > 5, F.col("i")).alias("i"),
        F.when(F.col("kind") == "a", "z").otherwise(F.col("kind")).alias("kind"),
        F.col("x").cast("string").alias("x"),
        F.lit(1).alias("extra"),
        "n",
    )
    anomalies = q.validate_profile(q.column_profile(odd), rules, q.unseen_values(odd, domains))
    found = {(r["column_name"], r["anomaly"]) for r in anomalies.collect()}
    assert found == {
        ("i", "low_presence"), ("kind", "unseen_category"), ("x", "type_change"), ("extra", "new_column"),
        ("label", "missing_column"), ("day", "missing_column"),
    }
    serving = q.validate_profile(q.column_profile(odd), q.environment_rules(rules, ["label", "day"]))
    assert "missing_column" not in {r["anomaly"] for r in serving.collect()}


def test_histogram_covers_every_value(table, spark):
    bins = q.value_histogram(table, "x", 7).collect()
    assert sum(r["n_rows"] for r in bins) == table.where(~F.isnan("x")).count()
    assert {r["bin"] for r in bins} <= set(range(7))
    constant = q.value_histogram(spark.range(5).select(F.lit(2.0).alias("k")), "k", 7).collect()
    assert [(r["bin"], r["n_rows"]) for r in constant] == [(0, 5)]


def test_drift_of_a_table_with_itself_and_with_a_shift(table):
    same = by_name(q.drift_distance(table, table, ["x", "i"]))
    assert same["x"]["ks"] == same["x"]["js"] == same["x"]["l_infinity"] == 0
    apart = table.withColumn("x", F.col("x") + 100)
    moved = q.drift_distance(apart, table, ["x", "i"])
    values = by_name(moved)
    assert values["x"]["ks"] == pytest.approx(1) and values["x"]["js"] == pytest.approx(1)
    signal = q.retrain_signal(moved, 0.5).first()
    assert (signal["retrain"], signal["n_drifted"], signal["worst_column"]) == (True, 1, "x")
    assert q.retrain_signal(moved, 0.5, exclude=["x"]).first()["retrain"] is False


def test_reconcile_counts(table):
    good = q.reconcile_counts(table, table, "day").first()
    bad = q.reconcile_counts(table, table.where("i > 0"), "day").first()
    assert good["agree"] is True and bad["agree"] is False
    assert (bad["expected_rows"], bad["actual_rows"]) == (501, 500)


@pytest.mark.parametrize("bins", [16, 1024])
def test_exact_medians_on_hard_values(spark, bins):
    rng = random.Random(2)
    inf, tiny = float("inf"), 5e-324
    columns = {
        "wild": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(101)],
        "ends": [-inf, inf, 1.7e308, -1.7e308, 0.0, 1.0] * 5,
        "tiny": [0.0, tiny, 2 * tiny, 3 * tiny],
        "same": [4.0] * 10,
        "holes": [None, float("nan"), 3.0, 1.0, 2.0],
        "empty": [None] * 3,
    }
    data = [{c: v[i] if i < len(v) else None for c, v in columns.items()} for i in range(101)]
    frame = spark.createDataFrame(data, ", ".join(f"{c} double" for c in columns))
    expected = {
        c: statistics.median_low(known)
        for c, values in columns.items()
        if (known := [v for v in values if v is not None and v == v])
    }
    assert q.exact_medians(frame, list(columns), bins) == expected


def test_median_modes(table):
    exact = by_name(q.column_profile(table, ["x"]))["x"]["median"]
    assert by_name(q.column_profile(table, ["x"], median="sketch"))["x"]["median"] == pytest.approx(exact, abs=0.05)
    assert by_name(q.column_profile(table, ["x"], median=None))["x"]["median"] is None
    with pytest.raises(ValueError):
        q.column_profile(table, ["x"], median="mean")


def test_domains_have_no_limit_and_names_are_case_blind(spark):
    train = spark.range(150).selectExpr("concat('v', id) as TAIL_NUM", "cast(id as double) as ARR_DELAY")
    profile = q.column_profile(train, median=None)
    rules = q.infer_expectations(profile)
    domains = q.infer_domains(train, rules)
    serve = spark.createDataFrame([("v7",), ("new",)], "TAIL_NUM string")
    unseen = q.unseen_values(serve, domains)
    assert domains.count() == 150 and [r["value"] for r in unseen.collect()] == ["new"]
    assert q.infer_expectations(profile, open_columns=["tail_num"]).where("has_domain").count() == 0
    found = q.validate_profile(q.column_profile(serve, median=None), q.environment_rules(rules), unseen)
    assert [r["anomaly"] for r in found.collect()] == ["unseen_category"]


def _shares(values):
    known = [v for v in values if v is not None and v == v]
    return {v: known.count(v) / len(known) for v in set(known)}


@pytest.mark.parametrize("partitions", [1, 5])
def test_unbinned_drift_against_plain_counts(spark, partitions):
    nan = float("nan")
    serve = [(i % 7 / 2, "abcd"[i % 4], i % 3) for i in range(60)] + [(nan, None, None), (100.0, "new", 9)]
    train = [(i % 5 / 2 - 0.5, "abc"[i % 3], i % 2) for i in range(45)] + [(None, "", 1)]
    schema = "x double, s string, k int, p double, c int"
    frames = [spark.createDataFrame([(*r, 0.0, 1) for r in rows], schema).repartition(3) for rows in (serve, train)]
    ks = {r["column_name"]: r["ks"] for r in drift.exact_ks(*frames, ["x", "k"], partitions).collect()}
    for name, place in (("x", 0), ("k", 2)):
        p, q = (_shares([r[place] for r in rows]) for rows in (serve, train))
        gaps = [abs(sum(s for v, s in p.items() if v <= x) - sum(s for v, s in q.items() if v <= x)) for x in {*p, *q}]
        assert ks[name] == pytest.approx(max(gaps))
    values = by_name(drift.value_drift(*frames, ["s", "k"]))
    for name, place in (("s", 1), ("k", 2)):
        p, q = (_shares([r[place] for r in rows]) for rows in (serve, train))
        both = {str(v): (p.get(v, 0.0), q.get(v, 0.0)) for v in {*p, *q}}
        worst = min(both, key=lambda v: (-round(abs(both[v][0] - both[v][1]), 12), v))
        js = sum(s / 2 * math.log2(s / ((a + b) / 2)) for a, b in both.values() for s in (a, b) if s)
        row = values[name]
        assert (row["n_values"], row["n_new"], row["worst_value"]) == (len(both), len(set(p) - set(q)), worst)
        assert row["l_infinity"] == pytest.approx(max(abs(a - b) for a, b in both.values())) and row["js"] == pytest.approx(js)


def test_unbinned_drift_of_a_side_without_values(spark, table):
    empty = table.where("false")
    assert {(r["l_infinity"], r["js"], r["worst_value"]) for r in drift.value_drift(empty, table).collect()} == {(None, None, None)}
    assert {r["ks"] for r in drift.exact_ks(table, empty, ["x"]).collect()} == {None}
    assert drift.value_drift(empty, empty, ["x"]).count() == 0 and drift.exact_ks(empty, empty, ["x"]).count() == 0
    assert {r["js"] for r in drift.value_drift(table, table).collect()} == {0.0}
