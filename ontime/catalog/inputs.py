"""Frames that several registered queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.functions import columns as c
from ontime.operators.aggregates import hourly_weather
from ontime.operators.filters import filter_completed
from ontime.plans.enriched import enriched_flights, prepare_trips
from ontime.plans.silver import silver_flights
from ontime.sources.fixtures import flights_v, weather_v


def completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_completed(flights_v(spark, sf_dir))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_weather(weather_v(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_flights(flights_v(spark, sf_dir))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_trips(silver(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_flights(silver(spark, sf_dir), hourly(spark, sf_dir))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with the derived predictions of the input in the layout of a prediction table."""
    return completed(spark, sf_dir).select(
        "flight_id", "fl_date", "tail_num",
        c.carrier_number("op_carrier", "op_carrier_fl_num").alias("op_carrier_fl_num"),
        "origin", "origin_city_name", "dest", "dest_city_name",
        c.hhmm_timestamp("fl_date", "crs_dep_time").alias("crs_dep_timestamp"),
        c.hhmm_timestamp("fl_date", "crs_arr_time").alias("crs_arr_timestamp"),
        (F.col("pred_delay") + 0.5).alias("dep_pred"),
        (F.col("pred_delay") + 0.75).alias("arr_pred"),
    )
