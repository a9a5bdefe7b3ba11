"""Arrival and departure boards from prediction tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.functions.columns import ColumnLike, estimated_clock, trip_status
from ontime.operators.filters import filter_like


def _board(
    predictions: DataFrame,
    endpoint: str,
    airport: str,
    as_of: ColumnLike | datetime,
    prediction: str,
    base: str,
    rounding: str | None,
    status_rule: str,
) -> DataFrame:
    return filter_like(predictions, endpoint, f"%{airport}%").select(
        F.col("tail_num").alias("flight_number"),
        F.col("dest").alias("destination"),
        F.col("dest_city_name").alias("destination_city"),
        trip_status("crs_dep_timestamp", "crs_arr_timestamp", as_of, status_rule).alias("flight_status"),
        estimated_clock(base, prediction, rounding).alias("estimate"),
    )


def arrival_board(
    predictions: DataFrame,
    airport: str,
    as_of: ColumnLike | datetime,
    prediction: str = "arr_pred",
    base: str = "crs_arr_timestamp",
    status_rule: str = "reference",
) -> DataFrame:
    """Trips to an airport with their status and estimated arrival."""
    return _board(predictions, "dest", airport, as_of, prediction, base, None, status_rule)


def departure_board(
    predictions: DataFrame,
    airport: str,
    as_of: ColumnLike | datetime,
    prediction: str = "dep_pred",
    base: str = "crs_arr_timestamp",
    status_rule: str = "reference",
) -> DataFrame:
    """Trips from an airport. The estimate adds whole predicted minutes to ``base``: by default the scheduled arrival;
    pass ``crs_dep_timestamp`` for the estimated departure."""
    return _board(predictions, "origin", airport, as_of, prediction, base, "half_even", status_rule)
