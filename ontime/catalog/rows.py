"""Queries on scans, sinks, filters, projections, joins and column builders."""

from __future__ import annotations

from datetime import date, datetime
from uuid import uuid4

from pyspark.sql import functions as F

from ontime.catalog import inputs
from ontime.catalog.registry import (
    AIRPORT, BASE, BASE_SQL, COMPLETED_CTE, DECODED_CTE, ENRICHED_CTES, HOURLY_CTE, PARAMS, PREDICTIONS_CTE,
    TRIPS_CTE, clock_sql, joined_measures, query, rounded, silver_cte, with_both, with_flights, with_weather,
)
from ontime.functions import columns as c
from ontime.functions.packed import MISSING_CODES, WEATHER_LAYOUT, decode_packed
from ontime.operators import filters, joins, projections
from ontime.operators.windows import previous_leg_flag
from ontime.plans.board import arrival_board, departure_board
from ontime.plans.enriched import serving_split, validation_ranges
from ontime.plans.silver import silver_flights
from ontime.schema import ENRICHED_COLUMNS, MEASURES, SILVER_COLUMNS
from ontime.sources import scans, sinks
from ontime.sources.fixtures import flights_v, read, weather_v

ALL_BASE = with_flights(f"select {BASE_SQL} from flights_v")


def _base(spark, sf_dir):
    return flights_v(spark, sf_dir).select(*BASE)


# Scans and sinks -----------------------------------------------------------------------------------------------------


@query("scan_table", ALL_BASE)
def _(spark, sf_dir):
    sinks.publish_table(_base(spark, sf_dir), "ontime_scan", sinks.stage_path(spark, "table"))
    return scans.scan_table(spark, "ontime_scan")


@query("scan_parquet", "select * from orders")
def _(spark, sf_dir):
    return scans.scan_parquet(spark, f"{sf_dir}/orders.parquet")


@query(
    "param_query",
    with_flights(
        "select fl_date, crs_dep_time, crs_arr_time, year, quarter, month, day_of_month, day_of_week, distance, "
        "distance_group, origin_airport_id, dest_airport_id, arr_delay, dep_delay from flights_v "
        "where fl_date between date '2024-01-01' and date '2024-01-20'"
    ),
)
def _(spark, sf_dir):
    return scans.param_query(
        spark,
        "select fl_date, crs_dep_time, crs_arr_time, year, quarter, month, day_of_month, day_of_week, distance, "
        "distance_group, origin_airport_id, dest_airport_id, arr_delay, dep_delay from {trips} "
        "where fl_date between :lo and :hi",
        {"lo": PARAMS.train_start, "hi": PARAMS.train_end},
        trips=flights_v(spark, sf_dir),
    )


@query("replace_parquet", ALL_BASE)
def _(spark, sf_dir):
    path = sinks.stage_path(spark, "replace")
    sinks.replace_parquet(_base(spark, sf_dir).withColumn("old", F.lit(1)), path)
    return sinks.replace_parquet(_base(spark, sf_dir), path)


@query(
    "publish_predictions",
    with_flights(
        "select flight_id, fl_date, dest as airport, arr_pred from predictions_v", COMPLETED_CTE, PREDICTIONS_CTE
    ),
)
def _(spark, sf_dir):
    rows = inputs.predictions(spark, sf_dir).select("flight_id", "fl_date", F.col("dest").alias("airport"), "arr_pred")
    path = sinks.stage_path(spark, "predictions")
    sinks.publish_predictions(rows, path)
    # a second run of one airport replaces that airport only
    return sinks.publish_predictions(rows.where(F.col("airport") == AIRPORT), path)


@query("publish_table", ALL_BASE)
def _(spark, sf_dir):
    return sinks.publish_table(_base(spark, sf_dir), "ontime_published", sinks.stage_path(spark, "table"))


@query("publish_table_by_date", ALL_BASE)
def _(spark, sf_dir):
    path = sinks.stage_path(spark, "table")
    return sinks.publish_table(_base(spark, sf_dir), "ontime_by_date", path, partition_by=("fl_date",))


@query(
    "register_view",
    with_flights("select origin, cast(count(*) as bigint) as n_trips from flights_v group by origin"),
)
def _(spark, sf_dir):
    scans.register_view(flights_v(spark, sf_dir), "ontime_trips_view")
    return spark.sql("select origin, count(*) as n_trips from ontime_trips_view group by origin")


@query("use_database", ALL_BASE)
def _(spark, sf_dir):
    before = spark.catalog.currentDatabase()
    name = f"ontime_{uuid4().hex[:12]}"
    spark.sql(
        "CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name) LOCATION '" + sinks.stage_path(spark, "database") + "'",
        args={"name": name},
    )
    try:
        scans.use_database(spark, name)
        sinks.publish_table(_base(spark, sf_dir), "trips")
        return scans.scan_table(spark, "trips")
    finally:
        scans.use_database(spark, before)


@query("sample_rows")
def _(spark, sf_dir):
    return scans.sample_rows(_base(spark, sf_dir), 0.1, seed=7)


@query(
    "sample_by_hash",
    with_flights(
        f"select {BASE_SQL} from flights_v "
        "where substr(md5('|' || cast(flight_id as varchar)), 1, 8) < '19999999'"
    ),
)
def _(spark, sf_dir):
    return scans.sample_by_hash(_base(spark, sf_dir), "flight_id", 0.1)


@query(
    "run_params",
    with_flights(
        "select fl_date, fl_date between date '2024-01-01' and date '2024-01-20' as in_training, "
        "fl_date = date '2024-01-20' + 1 as is_inference, cast(count(*) as bigint) as n_trips "
        "from flights_v where origin = 'AP1' or dest = 'AP1' group by 1, 2, 3"
    ),
)
def _(spark, sf_dir):
    day = F.col("fl_date")
    return (
        filters.filter_endpoint(flights_v(spark, sf_dir), PARAMS.airport)
        .groupBy(
            "fl_date",
            day.between(F.lit(PARAMS.train_start), F.lit(PARAMS.train_end)).alias("in_training"),
            (day == F.lit(PARAMS.inference)).alias("is_inference"),
        )
        .agg(F.count(F.lit(1)).alias("n_trips"))
    )


@query("stage_table", ALL_BASE)
def _(spark, sf_dir):
    return sinks.stage_table(_base(spark, sf_dir))


@query("cut_lineage", ALL_BASE)
def _(spark, sf_dir):
    return sinks.cut_lineage(_base(spark, sf_dir))


# Filters -------------------------------------------------------------------------------------------------------------


@query("filter_endpoint", with_flights(f"select {BASE_SQL} from flights_v where dest = 'AP1' or origin = 'AP1'"))
def _(spark, sf_dir):
    return filters.filter_endpoint(_base(spark, sf_dir), AIRPORT)


_INTERVALS = {
    "both": "fl_date >= date '2024-01-05' and fl_date <= date '2024-01-20'",
    "left": "fl_date >= date '2024-01-05' and fl_date < date '2024-01-20'",
    "right": "fl_date > date '2024-01-05' and fl_date <= date '2024-01-20'",
    "neither": "fl_date > date '2024-01-05' and fl_date < date '2024-01-20'",
}


def _register_dates(closed: str) -> None:
    @query(
        "filter_dates" if closed == "both" else f"filter_dates_{closed}",
        with_flights(f"select {BASE_SQL} from flights_v where {_INTERVALS[closed]}"),
    )
    def _(spark, sf_dir):
        return filters.filter_dates(_base(spark, sf_dir), date(2024, 1, 5), "2024-01-20", closed)


for _closed in _INTERVALS:
    _register_dates(_closed)


@query(
    "filter_dates_timestamp",
    with_weather(
        "select station, date, tmp from weather_v "
        "where cast(cast(date as date) as varchar) between '2024-01-05' and '2024-01-20'"
    ),
)
def _(spark, sf_dir):
    rows = weather_v(spark, sf_dir).select("station", "date", "tmp")
    return filters.filter_dates(rows, "2024-01-05", "2024-01-20", column="date")


@query("filter_completed", with_flights(f"select {BASE_SQL} from completed_v", COMPLETED_CTE))
def _(spark, sf_dir):
    return filters.filter_completed(flights_v(spark, sf_dir)).select(*BASE)


@query("filter_not_cancelled", with_flights(f"select {BASE_SQL} from flights_v where cancelled = 0"))
def _(spark, sf_dir):
    return filters.filter_not_cancelled(flights_v(spark, sf_dir)).select(*BASE)


@query("filter_not_null", with_flights(f"select {BASE_SQL} from flights_v where dest_state_abr is not null"))
def _(spark, sf_dir):
    return filters.filter_not_null(flights_v(spark, sf_dir)).select(*BASE)


@query(
    "filter_like",
    with_flights(f"select {BASE_SQL} from flights_v where origin || '-' || dest || '_' || "
                 "cast(fl_date as varchar) like '%AP1%'"),
)
def _(spark, sf_dir):
    return filters.filter_like(_base(spark, sf_dir), c.trip_id(c.route("origin", "dest"), "fl_date"), f"%{AIRPORT}%")


@query(
    "filter_report",
    with_weather("select station, name, report_type from weather_v "
                 "where report_type = 'FM-15' and name like '% AIRPORT%'"),
)
def _(spark, sf_dir):
    return filters.filter_report(weather_v(spark, sf_dir)).select("station", "name", "report_type")


def _register_edges(end: str, column: str) -> None:
    @query(
        f"filter_edges_{end}",
        with_flights(f"select flight_id, origin as src, dest as dst, dep_delay as delay from flights_v "
                     f"where {column} = 'AP1' and dep_delay > 0"),
    )
    def _(spark, sf_dir):
        edges = flights_v(spark, sf_dir).select(
            "flight_id", F.col("origin").alias("src"), F.col("dest").alias("dst"), F.col("dep_delay").alias("delay")
        )
        return filters.filter_edges(edges, end, AIRPORT)


_register_edges("src", "origin")
_register_edges("dst", "dest")


@query(
    "latest_partition",
    with_flights(f"select {BASE_SQL} from flights_v where fl_date = (select max(fl_date) from flights_v)"),
)
def _(spark, sf_dir):
    return filters.latest_partition(_base(spark, sf_dir))


@query("drop_any_null", with_flights("select flight_id, tail_num, arr_delay, carrier_delay from flights_v "
                                     "where tail_num is not null and arr_delay is not null "
                                     "and carrier_delay is not null"))
def _(spark, sf_dir):
    return filters.drop_any_null(
        flights_v(spark, sf_dir).select("flight_id", "tail_num", "arr_delay", "carrier_delay")
    )


@query(
    "flag_out_of_range",
    with_flights("select flight_id from flights_v where tail_num is null or dest_state_abr is null"),
)
def _(spark, sf_dir):
    rows = flights_v(spark, sf_dir).select(
        "flight_id",
        F.when(F.col("tail_num").isNull(), F.lit(float("nan"))).otherwise(F.col("distance")).alias("x"),
        F.when(F.col("dest_state_abr").isNull(), F.lit(float("-inf"))).otherwise(F.col("taxi_out")).alias("y"),
    )
    return filters.flag_out_of_range(rows, ["x", "y"]).select("flight_id")


# Projections ---------------------------------------------------------------------------------------------------------


@query("project", with_flights("select tail_num, dest, dest_city_name from flights_v"))
def _(spark, sf_dir):
    return projections.project(flights_v(spark, sf_dir), ["tail_num", "dest", "dest_city_name"])


@query("project_rename", with_flights("select flight_id, crs_dep_time as dep_clock, crs_arr_time as arr_clock "
                                      "from flights_v"))
def _(spark, sf_dir):
    return projections.project_rename(
        flights_v(spark, sf_dir),
        ["flight_id", "crs_dep_time", "crs_arr_time"],
        {"crs_dep_time": "dep_clock", "crs_arr_time": "arr_clock"},
    )


@query("prefix_columns", "select r_regionkey as dep_r_regionkey, r_name as dep_r_name from region")
def _(spark, sf_dir):
    return projections.prefix_columns(read(spark, sf_dir, "region"), "dep_")


@query("rename", with_flights("select tail_num as flight_number, dest as destination from flights_v"))
def _(spark, sf_dir):
    names = {"tail_num": "flight_number", "dest": "destination"}
    return projections.rename(flights_v(spark, sf_dir).select("tail_num", "dest"), names)


@query("drop_columns", with_flights("select flight_id, fl_date, op_carrier, origin, dest from flights_v"))
def _(spark, sf_dir):
    return projections.drop_columns(_base(spark, sf_dir), ["dep_delay", "arr_delay"])


NUMERIC = ("dep_delay", "arr_delay", "dep_delay_new", "arr_delay_new", "carrier_delay", "weather_delay", "nas_delay",
           "security_delay", "late_aircraft_delay", "taxi_out", "taxi_in", "wheels_off", "wheels_on",
           "actual_elapsed_time", "air_time", "pred_delay", "distance")


@query("numeric_columns", with_flights("select flight_id, " + ", ".join(NUMERIC) + " from flights_v"))
def _(spark, sf_dir):
    rows = flights_v(spark, sf_dir)
    return rows.select("flight_id", *filters.numeric_columns(rows))


@query(
    "fill_nulls",
    with_flights("select flight_id, coalesce(arr_del15, 0) as arr_del15, coalesce(carrier_delay, 0) as carrier_delay, "
                 "coalesce(nas_delay, 0) as nas_delay from flights_v"),
)
def _(spark, sf_dir):
    rows = flights_v(spark, sf_dir).select("flight_id", "arr_del15", "carrier_delay", "nas_delay")
    return projections.fill_nulls(rows, {"arr_del15": 0, "carrier_delay": 0, "nas_delay": 0})


@query(
    "split_features_labels",
    with_flights("select round(cast(distance as double), 6) as distance, taxi_out, arr_delay, dep_delay from flights_v"),
)
def _(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    rows = projections.split_features_labels(
        flights_v(spark, sf_dir), ["distance", "taxi_out", "arr_delay"], ["arr_delay", "dep_delay"]
    )
    cells = vector_to_array("features")
    named = rows.select(cells[0].alias("distance"), cells[1].alias("taxi_out"), "arr_delay", "dep_delay")
    return rounded(named, ["distance"])


def _scaled_sql(lo_hi_from: str, source: str) -> str:
    cells = ", ".join(
        f"case when {x} is not null then round(coalesce(({x} - (select min({x}) from {lo_hi_from})) / "
        f"nullif((select max({x}) from {lo_hi_from}) - (select min({x}) from {lo_hi_from}), 0), 0), 6) end as {x}"
        for x in ("distance", "taxi_out", "arr_delay", "constant")
    )
    return f"select flight_id, {cells} from {source}"


_SCALE_CTES = (
    "all_v as (select flight_id, fl_date, distance, taxi_out, arr_delay, cast(3 as double) as constant from flights_v)",
    "train_v as (select * from all_v where fl_date < date '2024-01-21')",
    "serve_v as (select * from all_v where fl_date = date '2024-01-21')",
)
_SCALED = ["distance", "taxi_out", "arr_delay", "constant"]


def _scale_input(spark, sf_dir):
    return flights_v(spark, sf_dir).select(
        "flight_id", "fl_date", "distance", "taxi_out", "arr_delay", F.lit(3.0).alias("constant")
    )


@query("scale_minmax", with_flights(_scaled_sql("train_v", "serve_v"), *_SCALE_CTES))
def _(spark, sf_dir):
    train, serve = serving_split(_scale_input(spark, sf_dir), PARAMS)
    return rounded(projections.scale_minmax(serve, _SCALED, train).drop("fl_date"), _SCALED)


@query("scale_minmax_per_set", with_flights(_scaled_sql("serve_v", "serve_v"), *_SCALE_CTES))
def _(spark, sf_dir):
    _, serve = serving_split(_scale_input(spark, sf_dir), PARAMS)
    return rounded(projections.scale_minmax(serve, _SCALED).drop("fl_date"), _SCALED)


# Joins ---------------------------------------------------------------------------------------------------------------

_MEASURE_NAMES = {p: [p + m for m in MEASURES] for p in ("dep_", "arr_")}


def _register_enrich(name: str, side: str, hour: str, code: str, how: str, salt: int) -> None:
    operator = joins.enrich_departure if side == "dep_" else joins.enrich_arrival
    join = "join" if how == "inner" else "left join"

    @query(
        name,
        with_both(
            f"select t.flight_id, t.{hour}, t.{code}, {joined_measures('w', side)} from trips_v t "
            f"{join} hourly_v w on w.time = t.{hour} and w.code = t.{code}",
            COMPLETED_CTE, DECODED_CTE, HOURLY_CTE, silver_cte(), TRIPS_CTE,
        ),
    )
    def _(spark, sf_dir):
        trips = inputs.trips(spark, sf_dir).select("flight_id", hour, code)
        return rounded(operator(trips, inputs.hourly(spark, sf_dir), how, salt), _MEASURE_NAMES[side])


_register_enrich("enrich_departure", "dep_", "dep_time", "origin", "inner", 1)
_register_enrich("enrich_departure_salted", "dep_", "dep_time", "origin", "inner", 8)
_register_enrich("enrich_arrival", "arr_", "arr_time", "dest", "inner", 1)
_register_enrich("enrich_arrival_left", "arr_", "arr_time", "dest", "left", 1)


@query(
    "composite_key",
    with_flights(
        "select flight_id, cast(dep_time as varchar) || '-' || origin as dep_key, "
        "cast(arr_time as varchar) || '-' || dest as arr_key from trips_v",
        COMPLETED_CTE, silver_cte(), TRIPS_CTE,
    ),
)
def _(spark, sf_dir):
    return inputs.trips(spark, sf_dir).select(
        "flight_id",
        c.composite_key("dep_time", "origin").alias("dep_key"),
        c.composite_key("arr_time", "dest").alias("arr_key"),
    )


_PREDICTED = "predicted_v as (select flight_id, pred_delay from flights_v where tail_num is not null)"


def _ids_and_predictions(spark, sf_dir):
    rows = flights_v(spark, sf_dir)
    ids = rows.select("flight_id", "tail_num", "arr_delay")
    return ids, rows.where("tail_num is not null").select("flight_id", "pred_delay")


@query(
    "attach_predictions",
    with_flights("select f.flight_id, tail_num, arr_delay, p.pred_delay from flights_v f "
                 "join predicted_v p on p.flight_id = f.flight_id", _PREDICTED),
)
def _(spark, sf_dir):
    return joins.attach_predictions(*_ids_and_predictions(spark, sf_dir), ["flight_id"])


@query(
    "align_actuals",
    with_flights("select f.flight_id, tail_num, arr_delay, p.pred_delay from flights_v f "
                 "left join predicted_v p on p.flight_id = f.flight_id", _PREDICTED),
)
def _(spark, sf_dir):
    return joins.align_actuals(*_ids_and_predictions(spark, sf_dir), ["flight_id"])


@query(
    "decode_codes",
    "select c_custkey, c_nationkey, n_name as nation from customer left join nation on n_nationkey = c_nationkey",
)
def _(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return joins.decode_codes(
        customers, "c_nationkey", read(spark, sf_dir, "nation"), "nation", "n_nationkey", "n_name"
    )


@query(
    "decode_codes_fixed",
    with_flights("select flight_id, op_carrier, case op_carrier when 'C0' then 'Zero Air' when 'C1' then 'One Air' end "
                 "as carrier from flights_v"),
)
def _(spark, sf_dir):
    rows = flights_v(spark, sf_dir).select("flight_id", "op_carrier")
    return joins.decode_codes(rows, "op_carrier", {"C0": "Zero Air", "C1": "One Air"}, "carrier")


# Column builders -----------------------------------------------------------------------------------------------------


def _builder(name: str, sql: str, **builders) -> None:
    @query(name, with_flights(f"select flight_id, {sql} from flights_v"))
    def _(spark, sf_dir):
        rows = flights_v(spark, sf_dir)
        return rows.select("flight_id", *[build().alias(column) for column, build in builders.items()])


_builder(
    "hhmm_timestamp",
    f"{clock_sql('fl_date', 'crs_dep_time')} as dep_ts, {clock_sql('fl_date', 'crs_arr_time')} as arr_ts",
    dep_ts=lambda: c.hhmm_timestamp("fl_date", "crs_dep_time"),
    arr_ts=lambda: c.hhmm_timestamp("fl_date", "crs_arr_time"),
)
_builder(
    "hhmm_hour",
    "cast(round(cast(crs_dep_time as double) / 100) as int) as rounded_hour, "
    "cast(floor(cast(crs_dep_time as double) / 100) as int) as floor_hour",
    rounded_hour=lambda: c.hhmm_hour("crs_dep_time"),
    floor_hour=lambda: c.hhmm_hour("crs_dep_time", "floor"),
)
_builder(
    "block_hour",
    "cast(substr(dep_time_blk, 1, 2) as int) as dep_hour",
    dep_hour=lambda: c.block_hour("dep_time_blk"),
)
_builder(
    "route",
    "origin || '-' || dest as path, op_carrier || '_' || cast(op_carrier_fl_num as varchar) as number, "
    "origin || '-' || dest || '_' || cast(fl_date as varchar) as uni_id",
    path=lambda: c.route("origin", "dest"),
    number=lambda: c.carrier_number("op_carrier", "op_carrier_fl_num"),
    uni_id=lambda: c.trip_id(c.route("origin", "dest"), "fl_date"),
)
_builder("city_of", "split_part(dest_city_name, ',', 1) as city", city=lambda: c.city_of("dest_city_name"))
_builder(
    "elapsed_hours",
    "cast(round(cast(crs_elapsed_time as double) / 60) as int) as hours",
    hours=lambda: c.elapsed_hours("crs_elapsed_time"),
)
_builder(
    "delay15",
    "arr_del15 as flag, arr_del15 as flag_from_text",
    flag=lambda: c.delay15("arr_del15"),
    flag_from_text=lambda: c.delay15(F.concat(F.col("arr_del15").cast("string"), F.lit(".0"))),
)
_builder(
    "delay_level",
    "case when dep_delay_new > 45 then 2 when dep_delay_new > 5 then 1 else 0 end as level",
    level=lambda: c.delay_level("dep_delay_new"),
)


_DEP_CLOCK = clock_sql("fl_date", "crs_dep_time")


@query(
    "minute_text",
    with_flights(f"select flight_id, strftime({_DEP_CLOCK}, '%Y-%m-%d %H:%M') as text from flights_v"),
)
def _(spark, sf_dir):
    rows = flights_v(spark, sf_dir)
    return rows.select("flight_id", c.minute_text(c.hhmm_timestamp("fl_date", "crs_dep_time")).alias("text"))


@query(
    "at_time_of_day",
    with_flights(
        f"select flight_id, timestamp '2024-03-01 00:00:00' + ({_DEP_CLOCK} - date_trunc('day', {_DEP_CLOCK})) as moved "
        "from flights_v"
    ),
)
def _(spark, sf_dir):
    departs = c.hhmm_timestamp("fl_date", "crs_dep_time")
    return flights_v(spark, sf_dir).select(
        "flight_id", c.at_time_of_day(F.lit(date(2024, 3, 1)), departs).alias("moved")
    )


@query(
    "roll_overnight",
    with_flights(
        "select flight_id, arr_time as keep_hour, "
        "case when s.arr_hour <= s.dep_time then date_trunc('day', s.arr_hour) + interval 1 day else s.arr_hour end "
        "as midnight, "
        "case when s.crs_arr_timestamp <= s.crs_dep_timestamp then s.arr_hour + interval 1 day else s.arr_hour end "
        "as by_minute "
        "from (select t.*, v.arr_time as arr_hour from trips_v t join silver_v v using (flight_id)) s",
        COMPLETED_CTE, silver_cte(), TRIPS_CTE,
    ),
)
def _(spark, sf_dir):
    exact = ("crs_arr_timestamp", "crs_dep_timestamp")
    return inputs.silver(spark, sf_dir).select(
        "flight_id",
        c.roll_overnight("arr_time", "dep_time").alias("keep_hour"),
        c.roll_overnight("arr_time", "dep_time", "midnight").alias("midnight"),
        c.roll_overnight("arr_time", "dep_time", exact=exact).alias("by_minute"),
    )


@query(
    "station_code",
    with_weather("select station, date, substr(trim(call_sign), 2, 3) as code from weather_v"),
)
def _(spark, sf_dir):
    return weather_v(spark, sf_dir).select("station", "date", c.station_code("call_sign").alias("code"))


_DECODED = [field.name for field in WEATHER_LAYOUT] + ["precip_mm"]
_DECODED_NUMBERS = [field.name for field in WEATHER_LAYOUT if field.unit != "text"] + ["precip_mm"]


def _decoded_list() -> str:
    return ", ".join(f"round({n}, 6) as {n}" if n in _DECODED_NUMBERS else n for n in _DECODED)


@query("decode_packed", with_weather(f"select station, date, {_decoded_list()} from decoded_v", DECODED_CTE))
def _(spark, sf_dir):
    decoded = decode_packed(weather_v(spark, sf_dir)).select("station", "date", *_DECODED)
    return rounded(decoded, _DECODED_NUMBERS)


@query(
    "decode_packed_missing",
    with_weather(
        "select station, date, case when split_part(tmp, ',', 1) <> '+9999' then round(temp_f, 6) end as temp_f "
        "from decoded_v", DECODED_CTE,
    ),
)
def _(spark, sf_dir):
    decoded = decode_packed(weather_v(spark, sf_dir), missing_codes=MISSING_CODES)
    return rounded(decoded.select("station", "date", "temp_f"), ["temp_f"])


NOW = datetime(2024, 1, 15, 12, 0)
NOW_SQL = "timestamp '2024-01-15 12:00:00'"
_STATUS_SQL = {
    "reference": f"case when crs_arr_timestamp >= {NOW_SQL} then 'Landed' when crs_dep_timestamp < {NOW_SQL} and "
                 f"crs_arr_timestamp < {NOW_SQL} then 'En Route' when crs_dep_timestamp > {NOW_SQL} then 'Scheduled' "
                 "end",
    "clock": f"case when crs_dep_timestamp > {NOW_SQL} then 'Scheduled' when crs_arr_timestamp > {NOW_SQL} then "
             f"'En Route' when crs_arr_timestamp <= {NOW_SQL} then 'Landed' end",
}


@query(
    "trip_status",
    with_flights(
        f"select flight_id, {_STATUS_SQL['reference']} as status, {_STATUS_SQL['clock']} as clock_status "
        "from predictions_v", COMPLETED_CTE, PREDICTIONS_CTE,
    ),
)
def _(spark, sf_dir):
    times = ("crs_dep_timestamp", "crs_arr_timestamp", NOW)
    return inputs.predictions(spark, sf_dir).select(
        "flight_id", c.trip_status(*times).alias("status"), c.trip_status(*times, "clock").alias("clock_status")
    )


_ARRIVAL_ESTIMATE = "strftime(crs_arr_timestamp + to_microseconds(cast(round(arr_pred * 60000000) as bigint)), '%H:%M')"
_DEPARTURE_ESTIMATE = (
    "strftime(crs_arr_timestamp + to_microseconds(cast(round_even(dep_pred, 0) * 60000000 as bigint)), '%H:%M')"
)


@query(
    "estimated_clock",
    with_flights(
        f"select flight_id, {_ARRIVAL_ESTIMATE} as estimate, {_DEPARTURE_ESTIMATE} as whole_minutes "
        "from predictions_v", COMPLETED_CTE, PREDICTIONS_CTE,
    ),
)
def _(spark, sf_dir):
    return inputs.predictions(spark, sf_dir).select(
        "flight_id",
        c.estimated_clock("crs_arr_timestamp", "arr_pred").alias("estimate"),
        c.estimated_clock("crs_arr_timestamp", "dep_pred", "half_even").alias("whole_minutes"),
    )


# Tables --------------------------------------------------------------------------------------------------------------


@query(
    "previous_leg_flag",
    with_flights("select flight_id, tail_num, crs_dep_timestamp, pr_arr_del15 from silver_v",
                 COMPLETED_CTE, silver_cte()),
)
def _(spark, sf_dir):
    rows = inputs.completed(spark, sf_dir).select(
        "flight_id", "tail_num", c.hhmm_timestamp("fl_date", "crs_dep_time").alias("crs_dep_timestamp"), "arr_del15"
    )
    return previous_leg_flag(rows).drop("arr_del15")


@query(
    "previous_leg_flag_known_tails",
    with_flights("select flight_id, case when tail_num is not null then pr_arr_del15 end as pr_arr_del15 "
                 "from silver_v", COMPLETED_CTE, silver_cte()),
)
def _(spark, sf_dir):
    silver = silver_flights(flights_v(spark, sf_dir), null_keys="null")
    return silver.select("flight_id", "pr_arr_del15")


_SILVER = ["flight_id", *SILVER_COLUMNS, "dep_time", "arr_time"]
_SCOPED = "(origin = 'AP1' or dest = 'AP1') and fl_date between date '2024-01-01' and date '2024-01-21'"


@query("silver_flights", with_flights(f"select {', '.join(_SILVER)} from silver_v", COMPLETED_CTE, silver_cte()))
def _(spark, sf_dir):
    return inputs.silver(spark, sf_dir)


@query(
    "silver_flights_airport",
    with_flights(f"select {', '.join(_SILVER)} from silver_v",
                 COMPLETED_CTE, f"chosen_v as (select * from completed_v where {_SCOPED})", silver_cte("chosen_v")),
)
def _(spark, sf_dir):
    return silver_flights(flights_v(spark, sf_dir), PARAMS)


@query(
    "silver_flights_all_legs",
    with_flights(f"select {', '.join(_SILVER)} from silver_v where {_SCOPED}", COMPLETED_CTE, silver_cte()),
)
def _(spark, sf_dir):
    return silver_flights(flights_v(spark, sf_dir), PARAMS, scope="all")


_ENRICHED = ["flight_id", *ENRICHED_COLUMNS]


@query("enriched_flights", with_both(f"select {', '.join(_ENRICHED)} from enriched_v", *ENRICHED_CTES))
def enriched_query(spark, sf_dir):
    return rounded(inputs.enriched(spark, sf_dir), [*_MEASURE_NAMES["dep_"], *_MEASURE_NAMES["arr_"]])


_SPLIT = "cast(count(*) as bigint) as n_rows, min(fl_date) as first_day, max(fl_date) as last_day"


def _extent(df, part: str):
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("fl_date").alias("first_day"), F.max("fl_date").alias("last_day")
    ).withColumn("part", F.lit(part))


@query(
    "serving_split",
    with_flights(f"select {_SPLIT}, 'train' as part from flights_v where fl_date < date '2024-01-21' union all "
                 f"select {_SPLIT}, 'serve' as part from flights_v where fl_date = date '2024-01-21'"),
)
def _(spark, sf_dir):
    train, serve = serving_split(flights_v(spark, sf_dir), PARAMS)
    return _extent(train, "train").unionByName(_extent(serve, "serve"))


@query(
    "validation_ranges",
    with_flights(
        f"select {_SPLIT}, 'train' as part from flights_v where fl_date between date '2024-01-01' and "
        f"date '2024-01-20' union all select {_SPLIT}, 'serve' as part from flights_v "
        "where fl_date between date '2024-01-20' and date '2024-01-21'"
    ),
)
def _(spark, sf_dir):
    train, serve = validation_ranges(flights_v(spark, sf_dir), PARAMS)
    return _extent(train, "train").unionByName(_extent(serve, "serve"))


def _board_sql(endpoint: str, estimate: str, rule: str) -> str:
    return with_flights(
        f"select tail_num as flight_number, dest as destination, dest_city_name as destination_city, "
        f"{_STATUS_SQL[rule]} as flight_status, {estimate} as estimate from predictions_v "
        f"where {endpoint} like '%AP1%'",
        COMPLETED_CTE, PREDICTIONS_CTE,
    )


@query("arrival_board", _board_sql("dest", _ARRIVAL_ESTIMATE, "reference"))
def _(spark, sf_dir):
    return arrival_board(inputs.predictions(spark, sf_dir), AIRPORT, NOW)


@query("departure_board", _board_sql("origin", _DEPARTURE_ESTIMATE, "reference"))
def _(spark, sf_dir):
    return departure_board(inputs.predictions(spark, sf_dir), AIRPORT, NOW)


@query("departure_board_clock", _board_sql("origin", _DEPARTURE_ESTIMATE.replace("crs_arr_timestamp", "crs_dep_timestamp"),
                                           "clock"))
def _(spark, sf_dir):
    return departure_board(
        inputs.predictions(spark, sf_dir), AIRPORT, NOW, base="crs_dep_timestamp", status_rule="clock"
    )
