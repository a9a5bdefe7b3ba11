"""Raw trips to typed trips with timestamps and the flag of the previous leg."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.functions import columns as c
from ontime.operators.filters import filter_completed, filter_dates, filter_endpoint
from ontime.operators.windows import previous_leg_flag
from ontime.params import RunParams
from ontime.schema import SILVER_COLUMNS

_AS_TEXT = ("year", "quarter", "month", "day_of_month", "day_of_week", "distance_group")


def silver_flights(
    df: DataFrame,
    params: RunParams | None = None,
    tie: Sequence[str] = ("flight_id",),
    keep: Sequence[str] = ("flight_id",),
    scope: str = "filtered",
    hour_mode: str = "round",
    null_keys: str = "group",
    slice_by: str | None = "day",
) -> DataFrame:
    """Completed trips of an airport and period with derived columns and the previous leg's delay flag.

    ``scope`` says which legs count as previous: those left after the airport and date filters (``filtered``) or all
    completed ones (``all``). Without ``params`` all trips are taken. ``keep`` names further columns to carry along;
    columns of the standard list that the source lacks are left out.
    """
    if scope not in ("filtered", "all"):
        raise ValueError(f"scope {scope!r} is neither 'filtered' nor 'all'")

    def chosen(trips: DataFrame) -> DataFrame:
        if params is None:
            return trips
        return filter_dates(filter_endpoint(trips, params.airport), params.train_start, params.inference)

    source = filter_completed(chosen(df) if scope == "filtered" else df)
    present = {name.lower() for name in source.columns}
    derived = {
        "fl_date": F.col("fl_date").cast("date"),
        "fl_path": c.route("origin", "dest"),
        "op_carrier_fl_num": c.carrier_number("op_carrier", "op_carrier_fl_num"),
        "dep_time_hour": c.block_hour("dep_time_blk"),
        "crs_dep_time_hour": c.hhmm_hour("crs_dep_time", hour_mode),
        "crs_arr_time_hour": c.hhmm_hour("crs_arr_time", hour_mode),
        "dep_del15": c.delay15("dep_del15"),
        "arr_del15": c.delay15("arr_del15"),
        "crs_dep_timestamp": c.hhmm_timestamp("fl_date", "crs_dep_time"),
        "crs_arr_timestamp": c.hhmm_timestamp("fl_date", "crs_arr_time"),
    }
    if "arr_time_blk" in present:
        derived["arr_time_hour"] = c.block_hour("arr_time_blk")
    derived |= {name: F.col(name).cast("string") for name in _AS_TEXT if name in present}
    columns = [n for n in SILVER_COLUMNS if n != "pr_arr_del15" and (n in derived or n in present)]
    extra = [n for n in dict.fromkeys((*keep, *tie)) if n.lower() in present and n not in columns]
    typed = source.select(*extra, *[derived.get(n, F.col(n)).alias(n) for n in columns])
    flagged = previous_leg_flag(typed, tie=tie, null_keys=null_keys, slice_by=slice_by)
    silver = flagged.withColumns({"dep_time": c.hour_of("crs_dep_timestamp"), "arr_time": c.hour_of("crs_arr_timestamp")})
    return chosen(silver) if scope == "all" else silver
