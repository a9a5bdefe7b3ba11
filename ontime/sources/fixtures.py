"""Trip and weather inputs derived from the order and event tables; the text is valid in Spark and DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_NUMBER = "cast({} as varchar(20))"
_ORIGIN = "o_orderkey % 5"
_DEST = "(o_orderkey + 1 + o_custkey % 4) % 5"
_DEP_HOUR = "(o_orderkey * 7 + o_custkey) % 24"
_ARR_HOUR = "(o_orderkey * 7 + o_custkey + 1 + o_custkey % 6) % 24"
_DEP_DELAY = "o_orderkey * 31 % 90 - 30"
_ARR_DELAY = "(o_orderkey * 31 + o_custkey * 5) % 90 - 30"
_KNOWN = "case when o_orderkey % 53 = 0 then null"


def _text(expr: str) -> str:
    return _NUMBER.format(expr)


def _block(hour: str) -> str:
    padded = f"lpad({_text(hour)}, 2, '0')"
    return f"concat({padded}, '00-', {padded}, '59')"


FLIGHTS_SQL = f"""
select o_orderkey as flight_id,
 date '2024-01-01' + cast(o_orderkey % 30 as int) as fl_date,
 2024 as year, 1 as quarter, 1 as month,
 cast(o_orderkey % 30 + 1 as int) as day_of_month,
 cast(o_orderkey % 30 % 7 + 1 as int) as day_of_week,
 case when o_orderkey % 97 = 0 then null else concat('N', {_text("o_custkey % 200")}) end as tail_num,
 concat('C', {_text("o_custkey % 7")}) as op_carrier,
 concat('C', {_text("o_custkey % 7")}) as op_unique_carrier,
 cast(o_orderkey % 3000 as int) as op_carrier_fl_num,
 concat('AP', {_text(_ORIGIN)}) as origin,
 concat('AP', {_text(_DEST)}) as dest,
 concat('City', {_text(_ORIGIN)}, ', ST', {_text(_ORIGIN + " % 3")}) as origin_city_name,
 concat('City', {_text(_DEST)}, ', ST', {_text(_DEST + " % 3")}) as dest_city_name,
 concat('ST', {_text(_ORIGIN + " % 3")}) as origin_state_abr,
 case when o_orderkey % 71 = 0 then null else concat('ST', {_text(_DEST + " % 3")}) end as dest_state_abr,
 cast(10000 + {_ORIGIN} as int) as origin_airport_id,
 cast(10000 + {_DEST} as int) as dest_airport_id,
 cast(1000000 + {_ORIGIN} as int) as origin_airport_seq_id,
 cast({_DEP_HOUR} as int) * 100 + cast((o_custkey * 13) % 60 as int) as crs_dep_time,
 cast({_ARR_HOUR} as int) * 100 + cast((o_orderkey * 17) % 60 as int) as crs_arr_time,
 {_block(_DEP_HOUR)} as dep_time_blk,
 {_block(_ARR_HOUR)} as arr_time_blk,
 cast(45 + o_orderkey % 300 as int) as crs_elapsed_time,
 {_KNOWN} else cast({_DEP_DELAY} as double) end as dep_delay,
 {_KNOWN} else cast({_ARR_DELAY} as double) end as arr_delay,
 {_KNOWN} else cast(greatest({_DEP_DELAY}, 0) as double) end as dep_delay_new,
 {_KNOWN} else cast(greatest({_ARR_DELAY}, 0) as double) end as arr_delay_new,
 {_KNOWN} when {_ARR_DELAY} >= 15 then 1 else 0 end as arr_del15,
 {_KNOWN} when {_DEP_DELAY} >= 15 then 1 else 0 end as dep_del15,
 case when o_orderkey % 4 = 0 then cast(o_custkey % 60 as double) end as carrier_delay,
 case when o_orderkey % 6 = 0 then cast(o_custkey % 40 as double) end as weather_delay,
 case when o_orderkey % 9 = 0 then cast(o_custkey % 30 as double) end as nas_delay,
 case when o_orderkey % 40 = 0 then cast(o_custkey % 15 as double) end as security_delay,
 case when o_orderkey % 7 = 0 then cast(o_custkey % 50 as double) end as late_aircraft_delay,
 cast(5 + o_custkey % 20 as double) as taxi_out,
 cast(3 + o_custkey % 12 as double) as taxi_in,
 cast({_DEP_HOUR} * 100 + (o_custkey * 13 + 20) % 60 as double) as wheels_off,
 cast({_ARR_HOUR} * 100 + (o_orderkey * 17 + 10) % 60 as double) as wheels_on,
 {_KNOWN} else cast(40 + o_orderkey % 310 as double) end as actual_elapsed_time,
 {_KNOWN} else cast(25 + o_orderkey % 280 as double) end as air_time,
 cast({_ARR_DELAY} + o_orderkey % 11 - 5 as double) as pred_delay,
 case when o_orderstatus = 'P' and o_orderkey % 10 = 0 then 1 else 0 end as cancelled,
 case when o_orderstatus = 'F' and o_orderkey % 50 = 0 then 1 else 0 end as diverted,
 cast(o_orderkey % 11 + 1 as int) as distance_group,
 o_totalprice / 1000 as distance
 from orders"""

_STATION = "user_id % 5"


def _digits(expr: str, width: int) -> str:
    return f"lpad({_text(expr)}, {width}, '0')"


WEATHER_SQL = f"""
select concat('S', {_text(_STATION)}) as station,
 concat('KAP', {_text(_STATION)}, ' ') as call_sign, ts as date,
 cast({_STATION} as double) as latitude, cast(-({_STATION}) as double) as longitude,
 case when event_id % 11 = 0 then 'FM-12' else 'FM-15' end as report_type,
 case when event_id % 13 = 0 then 'NOWHERE FIELD'
  else concat('CITY ', {_text(_STATION)}, ' AIRPORT, US') end as name,
 case when event_id % 29 = 0 then '+9999,9' else concat('+', {_digits("event_id % 400", 4)}, ',1') end as tmp,
 concat('180,1,N,', {_digits("user_id % 150", 4)}, ',1') as wnd,
 concat({_digits("event_id * 7 % 16000", 6)}, ',1,N,1') as vis,
 concat('-', {_digits("event_id % 150", 4)}, ',1') as dew,
 concat({_digits("9900 + event_id % 400", 5)}, ',1') as slp,
 case when event_id % 3 = 0 then ''
  else concat(case when event_id % 31 = 0 then '00' else '01' end, ',', {_digits("event_id % 80", 4)}, ',9,5')
  end as aa1
 from events"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def flights_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FLIGHTS_SQL.replace("from orders", "from {orders}"), orders=read(spark, sf_dir, "orders"))


def weather_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(WEATHER_SQL.replace("from events", "from {events}"), events=read(spark, sf_dir, "events"))
