"""Typed trips with the weather at both ends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.functions.columns import city_of, roll_overnight
from ontime.operators.filters import filter_dates
from ontime.operators.joins import enrich_arrival, enrich_departure
from ontime.params import RunParams
from ontime.schema import ENRICHED_COLUMNS


def prepare_trips(silver: DataFrame, roll: str = "keep_hour", exact_roll: bool = False) -> DataFrame:
    """City names and the arrival hour rolled over midnight."""
    exact = ("crs_arr_timestamp", "crs_dep_timestamp") if exact_roll else None
    return silver.withColumns(
        {
            "origin_city": city_of("origin_city_name"),
            "dest_city": city_of("dest_city_name"),
            "arr_time": roll_overnight("arr_time", "dep_time", roll, exact),
        }
    )


def enriched_flights(
    silver: DataFrame,
    weather: DataFrame,
    keep: Sequence[str] = ("flight_id",),
    roll: str = "keep_hour",
    exact_roll: bool = False,
    how: str = "inner",
    salt: int = 1,
) -> DataFrame:
    """Trips with the hourly weather (one row per hour and station code) of departure and arrival."""
    trips = prepare_trips(silver, roll, exact_roll)
    joined = enrich_arrival(enrich_departure(trips, weather, how, salt), weather, how, salt)
    present = {name.lower() for name in joined.columns}
    columns = [n for n in dict.fromkeys((*keep, *ENRICHED_COLUMNS)) if n in present]
    return joined.select(*columns)


def serving_split(df: DataFrame, params: RunParams, column: str = "fl_date") -> tuple[DataFrame, DataFrame]:
    """Rows to train on (before the inference date) and rows to predict (on it)."""
    train = filter_dates(df, hi=params.inference, closed="neither", column=column)
    serve = filter_dates(df, params.inference, params.inference, column=column)
    return train, serve


def validation_ranges(
    df: DataFrame, params: RunParams, column: str = "fl_date", serve_lower_inclusive: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Training range and serving range to compare; the last training day is in both unless told otherwise."""
    train = filter_dates(df, params.train_start, params.train_end, column=column)
    closed = "both" if serve_lower_inclusive else "right"
    return train, filter_dates(df, params.train_end, params.inference, closed, column)


def weather_for(df: DataFrame, params: RunParams, column: str = "date") -> DataFrame:
    """Raw weather of the days a run can need: an overnight trip lands one day after the inference date."""
    padded_end = F.date_add(F.lit(params.inference), 1)
    return df.where((F.col(column) >= F.lit(params.train_start)) & (F.col(column) < F.date_add(padded_end, 1)))
