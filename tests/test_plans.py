"""Physical plans: pushdown, pruning, join choice, no Python in the data path."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from conftest import MEDIUM

import ontime
from ontime.catalog import inputs
from ontime.operators import aggregates, filters, joins
from ontime.operators.windows import previous_leg_flag
from ontime.sources import scans, sinks
from ontime.sources.fixtures import flights_v, weather_v


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def flights(spark):
    return sinks.stage_table(flights_v(spark, MEDIUM))


@pytest.fixture(scope="module")
def hourly(spark):
    return sinks.stage_table(aggregates.hourly_weather(weather_v(spark, MEDIUM)))


def test_sources_stay_on_spark():
    banned = re.compile(r"toPandas|\.rdd\b|\budf\(|pandas|localCheckpoint|crossJoin|F\.broadcast|import numpy")
    package = Path(ontime.__file__).parent
    for file in package.rglob("*.py"):
        if file.is_relative_to(package / "llm"):  # operators there may run numpy over Arrow batches
            continue
        assert not banned.search(file.read_text()), file


def test_filters_reach_the_scan(flights):
    narrowed = filters.filter_dates(filters.filter_completed(flights), "2024-01-05", "2024-01-20")
    plan = plan_of(filters.filter_endpoint(narrowed, "AP1").select("flight_id"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema: (\S+)", plan)
    assert "GreaterThanOrEqual(fl_date" in pushed[1] and "LessThanOrEqual(fl_date" in pushed[1]
    assert "EqualTo(dest,AP1)" in pushed[1] and "cancelled" in pushed[1]
    assert "taxi_out" not in pushed[2]


def test_timestamp_ranges_reach_the_scan(spark):
    events = spark.read.parquet(f"{MEDIUM}/events.parquet")
    plan = plan_of(filters.filter_dates(events, "2024-01-05", "2024-01-06", column="ts"))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_partitions_are_pruned(flights, spark):
    path = sinks.stage_path(spark, "dates")
    stored = sinks.replace_parquet(flights.select("flight_id", "fl_date"), path, partition_by=["fl_date"])
    plan = plan_of(filters.filter_dates(stored, "2024-01-05", "2024-01-06"))
    assert re.search(r"PartitionFilters: \[isnotnull\(fl_date", plan)
    assert filters.latest_partition(stored).count() == flights.where("fl_date = '2024-01-30'").count()


def test_dates_of_a_published_table_come_from_the_catalog(flights, spark):
    path = sinks.stage_path(spark, "dates")
    stored = sinks.publish_table(
        flights.select("flight_id", "fl_date"), "ontime_dates", path, partition_by=["fl_date"]
    )
    dates = scans.partition_values(spark, "ontime_dates", "fl_date")
    assert "FileScan" not in plan_of(aggregates.date_bounds(dates))
    assert aggregates.date_bounds(dates).collect() == aggregates.date_bounds(stored).collect()
    latest = filters.latest_partition(stored, dates=dates)
    assert plan_of(latest).count("FileScan") == 1
    assert sorted(latest.collect()) == sorted(filters.latest_partition(stored).collect())
    spark.sql("drop table ontime_dates")


def test_partition_values_are_unescaped(spark):
    values = ["a+b", "50%", "x/y=z", "ü", None]
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "key string, part int")
    sinks.publish_table(rows.withColumn("v", F.lit(1)), "ontime_keys", sinks.stage_path(spark, "keys"),
                        partition_by=["part", "key"])
    found = scans.partition_values(spark, "ontime_keys", "key")
    assert {r[0] for r in found.collect()} == set(values)
    assert {r[0] for r in scans.partition_values(spark, "ontime_keys", "part").collect()} == set(range(5))
    spark.sql("drop table ontime_keys")


def test_latest_partition_moves_no_rows(flights):
    plan = plan_of(filters.latest_partition(flights).select("flight_id"))
    main = plan[: plan.index("Subquery")] if "Subquery" in plan else plan
    assert "Exchange" not in main and "Join" not in plan


def test_weather_is_broadcast_only_while_small(spark, flights, hourly):
    trips = flights.select("flight_id", F.col("origin"), F.date_trunc("hour", "fl_date").alias("dep_time"))
    assert "BroadcastHashJoin" in plan_of(joins.enrich_departure(trips, hourly))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1KB")
    try:
        plan = plan_of(joins.enrich_departure(trips, hourly))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hourly_weather_is_aggregated_once_for_both_joins(spark):
    enriched = inputs.enriched(spark, MEDIUM)
    enriched.write.format("noop").mode("overwrite").save()
    enriched.collect()
    assert "ReusedExchange" in plan_of(enriched) or "ReusedQueryStage" in plan_of(enriched)


def test_previous_leg_window_is_split_by_day(flights):
    trips = flights.withColumn("crs_dep_timestamp", F.col("fl_date").cast("timestamp"))
    plan = plan_of(previous_leg_flag(trips.select("flight_id", "tail_num", "crs_dep_timestamp", "arr_del15")))
    assert re.search(r"Exchange hashpartitioning\(tail_num#\d+, _slice#\d+", plan)
    assert "partial_max_by" in plan


def test_top_k_needs_no_full_sort(flights):
    counts = flights.groupBy("tail_num").agg(F.count(F.lit(1)).alias("n"))
    assert "TakeOrderedAndProject" in plan_of(aggregates.top_k(counts, "n", 5, ["tail_num"]))


def test_aggregates_combine_before_the_shuffle(flights):
    assert "partial_avg" in plan_of(aggregates.mean_delay_pivot(flights, ["C0", "C1"]))
    assert "partial_" in plan_of(aggregates.correlation_matrix(flights, ["dep_delay", "distance"]))
