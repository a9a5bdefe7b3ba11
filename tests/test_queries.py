"""Every registered query against its SQL on the same tables, and the known totals of the inputs."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F
from conftest import MEDIUM, SMALL

import __spark_entry__ as entry_point
from ontime.catalog import ORACLES, QUERIES, groups, inputs
from ontime.operators.filters import numeric_columns
from ontime.operators.graph import build_graph, pagerank
from ontime.sources.fixtures import flights_v, weather_v

# Checked against a brute-force or behavioural test elsewhere in this folder.
ROWS_ONLY = {
    "sample_rows", "fit_random_forest", "fit_random_forest_departure", "fit_boosted_trees", "fit_boosted_trees_sub",
    "grid_search", "cross_validate", "sequential_search", "log_runs", "select_and_save", "score", "compare_models", "staged_error",
    "run_to_boards", "monitoring_job", "monitoring_job_weather",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def comparable(table):
    def cell(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return "null"
        if isinstance(value, datetime.datetime):
            return str(value.replace(tzinfo=None))
        return str(value + 0.0 if isinstance(value, float) else value)

    columns = [table.column(c).to_pylist() for c in sorted(table.column_names)]
    return sorted(tuple(map(cell, row)) for row in zip(*columns, strict=True))


TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
         "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def test_registry():
    assert entry_point.queries().keys() >= QUERIES.keys()  # the text operators add theirs when they are present
    assert entry_point.oracle_sql().keys() & QUERIES.keys() == QUERIES.keys() - ROWS_ONLY


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SMALL)
    expected = duck.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(expected.columns)
    declared = {f.name: TYPES[f.dataType.simpleString()] for f in result.schema.fields}
    assert declared == dict(zip(expected.columns, map(str, expected.types), strict=True))
    assert comparable(result.toArrow()) == comparable(expected.to_arrow_table())


@pytest.mark.parametrize("name", ["sample_rows", "run_to_boards", "monitoring_job", "monitoring_job_weather"])
def test_rows_only_query(spark, name):
    assert QUERIES[name](spark, MEDIUM).count() > 0


def test_a_day_without_trips_gives_empty_boards(spark):
    assert QUERIES["run_to_boards"](spark, SMALL).count() == 0


def test_flagship(spark):
    assert entry_point.entry(spark).count() == 56


def test_control_values(spark):
    flights, done = flights_v(spark, MEDIUM), inputs.completed(spark, MEDIUM)
    assert (flights.count(), flights.where("tail_num is not null").count(), done.count()) == (15000, 14845, 14383)
    flags = inputs.silver(spark, MEDIUM).agg(F.sum("pr_arr_del15"), F.count("pr_arr_del15")).first()
    assert tuple(flags) == (7013, 13919)
    assert weather_v(spark, MEDIUM).count() == 10000
    hours = inputs.hourly(spark, MEDIUM).agg(
        F.count(F.lit(1)), F.sum("avg_temp_f"), F.sum("tot_precip_mm"), F.count("tot_precip_mm")
    ).first()
    assert tuple(hours) == pytest.approx((3257, 428777.5116, 21380.8, 2825))
    joined = inputs.enriched(spark, MEDIUM).agg(F.count(F.lit(1)), F.sum("dep_avg_temp_f"), F.sum("arr_avg_temp_f"))
    assert tuple(joined.first()) == pytest.approx((11973, 1419467.057, 1581251.045))
    ranks = {r["id"]: r["pagerank"] for r in pagerank(*build_graph(flights)).collect()}
    known = {"AP0": 0.988694, "AP1": 1.003429, "AP2": 0.998316, "AP3": 0.994659, "AP4": 1.014902}
    assert ranks == pytest.approx(known, abs=1e-6)


def test_all_columns_are_in_the_results(spark):
    flights, rich = flights_v(spark, SMALL), inputs.enriched(spark, SMALL)
    assert set(groups.ALL_COLUMNS) == set(flights.columns)
    assert sorted(groups.ALL_DOUBLES) == sorted(numeric_columns(flights))
    assert sorted(groups.ALL_ENRICHED) == sorted(numeric_columns(rich))
    assert {r[0] for r in QUERIES["correlation_matrix_all"](spark, SMALL).collect()} == set(groups.ALL_DOUBLES)
    assert {r[0] for r in QUERIES["drift_distance_all"](spark, SMALL).collect()} == set(groups.ALL_NUMBERS)
