"""Registered queries: each name has a Spark callable and, where SQL can say it, the equivalent SQL text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.params import run_params
from ontime.schema import MEASURES
from ontime.sources.fixtures import FLIGHTS_SQL, WEATHER_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AIRPORT = "AP1"
CARRIERS = tuple(f"C{i}" for i in range(7))
PARAMS = run_params(AIRPORT, "2024-01-01", "2024-01-20", airports=None)
BASE = ("flight_id", "fl_date", "op_carrier", "origin", "dest", "dep_delay", "arr_delay")
BASE_SQL = ", ".join(BASE)


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def with_flights(body: str, *ctes: str) -> str:
    return _with([f"flights_v as ({FLIGHTS_SQL})", *ctes], body)


def with_weather(body: str, *ctes: str) -> str:
    return _with([f"weather_v as ({WEATHER_SQL})", *ctes], body)


def with_both(body: str, *ctes: str) -> str:
    return _with([f"flights_v as ({FLIGHTS_SQL})", f"weather_v as ({WEATHER_SQL})", *ctes], body)


def _with(ctes: Sequence[str], body: str) -> str:
    return f"with {', '.join(ctes)} {body}"


# SQL of the derived tables that several oracles share.


def clock_sql(day: str, hhmm: str) -> str:
    digits = f"lpad(cast({hhmm} as varchar), 4, '0')"
    return (
        f"try_cast(cast({day} as varchar) || ' ' || substr({digits}, 1, 2) || ':' || substr({digits}, 3, 2) || ':00' "
        "as timestamp)"
    )


COMPLETED_CTE = "completed_v as (select * from flights_v where cancelled <> 1 and diverted <> 1)"

DECODED_CTE = """decoded_v as (
 select *,
  try_cast(split_part(tmp, ',', 1) as double) * 9 / 50 + 32 as temp_f,
  nullif(split_part(tmp, ',', 2), '') as temp_qual,
  nullif(split_part(wnd, ',', 1), '') as wnd_deg,
  nullif(split_part(wnd, ',', 2), '') as wnd_1,
  nullif(split_part(wnd, ',', 3), '') as wnd_2,
  try_cast(split_part(wnd, ',', 4) as double) / 10 as wnd_mps,
  nullif(split_part(wnd, ',', 5), '') as wnd_4,
  try_cast(split_part(vis, ',', 1) as double) as vis_m,
  nullif(split_part(vis, ',', 2), '') as vis_1,
  nullif(split_part(vis, ',', 3), '') as vis_2,
  nullif(split_part(vis, ',', 4), '') as vis_3,
  try_cast(split_part(dew, ',', 1) as double) * 9 / 50 + 32 as dew_pt_f,
  nullif(split_part(dew, ',', 2), '') as dew_1,
  try_cast(split_part(slp, ',', 1) as double) / 10 as slp_hpa,
  nullif(split_part(slp, ',', 2), '') as slp_1,
  try_cast(split_part(aa1, ',', 1) as double) as precip_hr_dur,
  try_cast(split_part(aa1, ',', 2) as double) / 10 as precip_mm_intvl,
  nullif(split_part(aa1, ',', 3), '') as precip_cond,
  nullif(split_part(aa1, ',', 4), '') as precip_qual,
  try_cast(split_part(aa1, ',', 2) as double) / 10
   / nullif(try_cast(split_part(aa1, ',', 1) as double), 0) as precip_mm
 from weather_v)"""

_HOURLY_MEASURES = """avg(temp_f) as avg_temp_f, sum(precip_mm) as tot_precip_mm, avg(wnd_mps) as avg_wnd_mps,
  avg(vis_m) as avg_vis_m, avg(slp_hpa) as avg_slp_hpa, avg(dew_pt_f) as avg_dewpt_f"""

HOURLY_CTE = f"""hourly_v as (
 select date_trunc('hour', date) as time, substr(rpad(trim(call_sign), 5, ' '), 2, 3) as code, {_HOURLY_MEASURES}
 from decoded_v where report_type = 'FM-15' and name like '% AIRPORT%' group by 1, 2)"""

HOURLY_ALL_CTE = f"""hourly_all_v as (
 select date_trunc('hour', date) as time, {_HOURLY_MEASURES}
 from decoded_v where report_type = 'FM-15' and name like '% AIRPORT%' group by 1)"""

_DEP_TS = clock_sql("fl_date", "crs_dep_time")
_ARR_TS = clock_sql("fl_date", "crs_arr_time")


def silver_cte(source: str = "completed_v", name: str = "silver_v") -> str:
    return f"""{name} as (
 select *, date_trunc('hour', crs_dep_timestamp) as dep_time, date_trunc('hour', crs_arr_timestamp) as arr_time,
  lag(arr_del15) over (partition by tail_num order by crs_dep_timestamp nulls first, flight_id) as pr_arr_del15
 from (
  select flight_id, dep_delay, arr_delay, cast(year as varchar) as year, cast(quarter as varchar) as quarter,
   cast(month as varchar) as month, cast(day_of_month as varchar) as day_of_month,
   cast(day_of_week as varchar) as day_of_week, fl_date, origin || '-' || dest as fl_path, op_unique_carrier,
   tail_num, op_carrier || '_' || cast(op_carrier_fl_num as varchar) as op_carrier_fl_num,
   origin, origin_city_name, origin_state_abr, dest, dest_city_name, dest_state_abr, crs_dep_time,
   cast(round(cast(crs_dep_time as double) / 100) as int) as crs_dep_time_hour,
   cast(substr(dep_time_blk, 1, 2) as int) as dep_time_hour, dep_delay_new, dep_time_blk, crs_arr_time,
   cast(round(cast(crs_arr_time as double) / 100) as int) as crs_arr_time_hour,
   cast(substr(arr_time_blk, 1, 2) as int) as arr_time_hour, arr_delay_new, carrier_delay, weather_delay,
   security_delay, late_aircraft_delay, taxi_out, wheels_off, wheels_on, taxi_in, actual_elapsed_time,
   arr_time_blk, distance, cast(distance_group as varchar) as distance_group, dep_del15, arr_del15,
   origin_airport_id, dest_airport_id, {_DEP_TS} as crs_dep_timestamp, {_ARR_TS} as crs_arr_timestamp
  from {source}) typed)"""


TRIPS_CTE = """trips_v as (
 select * exclude (arr_time), split_part(origin_city_name, ',', 1) as origin_city,
  split_part(dest_city_name, ',', 1) as dest_city,
  case when arr_time <= dep_time then arr_time + interval 1 day else arr_time end as arr_time
 from silver_v)"""


def joined_measures(alias: str, prefix: str, digits: int = 6) -> str:
    return ", ".join(f"round({alias}.{m}, {digits}) as {prefix}{m}" for m in MEASURES)


ENRICHED_CTE = f"""enriched_v as (
 select t.*, {joined_measures("d", "dep_")}, {joined_measures("a", "arr_")}
 from trips_v t
 join hourly_v d on d.time = t.dep_time and d.code = t.origin
 join hourly_v a on a.time = t.arr_time and a.code = t.dest)"""

ENRICHED_CTES = (COMPLETED_CTE, DECODED_CTE, HOURLY_CTE, silver_cte(), TRIPS_CTE, ENRICHED_CTE)

PREDICTIONS_CTE = f"""predictions_v as (
 select flight_id, fl_date, tail_num, op_carrier || '_' || cast(op_carrier_fl_num as varchar) as op_carrier_fl_num,
  origin, origin_city_name, dest, dest_city_name, {_DEP_TS} as crs_dep_timestamp, {_ARR_TS} as crs_arr_timestamp,
  pred_delay + 0.5 as dep_pred, pred_delay + 0.75 as arr_pred
 from completed_v)"""
