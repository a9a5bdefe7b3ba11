"""Queries on aggregates, order, profiles, validation, drift and the route graph."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ontime.catalog import inputs
from ontime.catalog.registry import (
    AIRPORT, CARRIERS, COMPLETED_CTE, DECODED_CTE, ENRICHED_CTES, HOURLY_ALL_CTE, HOURLY_CTE, PARAMS, query,
    rounded, with_both, with_flights, with_weather,
)
from ontime.functions import columns as c
from ontime.operators import aggregates as agg
from ontime.operators import drift, filters, graph, quality
from ontime.operators.models import best_run
from ontime.operators.projections import fill_nulls
from ontime.params import run_params
from ontime.plans.enriched import serving_split, validation_ranges
from ontime.plans.jobs import exploration_base
from ontime.schema import MEASURES, ZERO_FILLED
from ontime.sources.fixtures import flights_v, read, weather_v
from ontime.sources.scans import partition_values
from ontime.sources.sinks import publish_table, stage_path, stage_table

# Weather -------------------------------------------------------------------------------------------------------------

_MEASURES_SQL = ", ".join(f"round({m}, 6) as {m}" for m in MEASURES)


@query("hourly_weather", with_weather(f"select time, code, {_MEASURES_SQL} from hourly_v", DECODED_CTE, HOURLY_CTE))
def _(spark, sf_dir):
    return rounded(agg.hourly_weather(weather_v(spark, sf_dir)), MEASURES)


@query(
    "hourly_weather_all_stations",
    with_weather(f"select time, {_MEASURES_SQL} from hourly_all_v", DECODED_CTE, HOURLY_ALL_CTE),
)
def _(spark, sf_dir):
    return rounded(agg.hourly_weather(weather_v(spark, sf_dir), per_station=False), MEASURES)


# Delay aggregates ----------------------------------------------------------------------------------------------------


def _register_state(name: str, delay: str) -> None:
    @query(
        name,
        with_flights(
            f"select dest_state_abr as state, round(avg({delay}), 6) as avg_delay from completed_v "
            f"where origin = 'AP1' and {delay} > 0 group by 1 order by 2 desc, 1",
            COMPLETED_CTE,
        ),
    )
    def _(spark, sf_dir):
        return rounded(agg.avg_delay_by_state(inputs.completed(spark, sf_dir), AIRPORT, delay), ["avg_delay"])


_register_state("avg_delay_by_state", "dep_delay")
_register_state("avg_delay_by_state_arrival", "arr_delay")


def _register_ends(end: str) -> None:
    flag = {"origin": "dep_del15", "dest": "arr_del15"}[end]

    @query(
        f"delays_by_operator_{end}",
        with_flights(f"select op_carrier as operator, cast(count(dep_delay) as bigint) as n_delayed from flights_v "
                     f"where {end} = 'AP1' and dep_delay > 0 group by 1"),
    )
    def _(spark, sf_dir):
        return agg.delays_by_operator(flights_v(spark, sf_dir), AIRPORT, end)

    @query(
        f"delays_by_weekday_route_{end}",
        with_flights(f"select day_of_week as weekday, origin || '-' || dest as path, "
                     f"cast(count({flag}) as bigint) as n_flagged from flights_v "
                     f"where {end} = 'AP1' and dep_delay > 0 group by 1, 2"),
    )
    def _(spark, sf_dir):
        return agg.delays_by_weekday_route(flights_v(spark, sf_dir), AIRPORT, end)


_register_ends("origin")
_register_ends("dest")


@query(
    "delays_by_weekday_origin",
    with_flights("select day_of_week as weekday, origin as src, cast(count(dep_delay) as bigint) as n_delayed "
                 "from flights_v where dest = 'AP1' and dep_delay > 0 group by 1, 2"),
)
def _(spark, sf_dir):
    return agg.delays_by_weekday_origin(flights_v(spark, sf_dir), AIRPORT)


@query(
    "group_stats",
    with_flights("select origin, op_carrier, min(dep_delay_new) as min_value, max(dep_delay_new) as max_value, "
                 "cast(count(dep_delay_new) as bigint) as n_values, round(avg(dep_delay_new), 6) as mean_value "
                 "from flights_v group by 1, 2"),
)
def _(spark, sf_dir):
    return rounded(
        agg.group_stats(flights_v(spark, sf_dir), ["origin", "op_carrier"], "dep_delay_new"), ["mean_value"]
    )


@query(
    "group_stats_volume",
    "select l_suppkey, min(l_extendedprice) as min_value, max(l_extendedprice) as max_value, "
    "cast(count(l_extendedprice) as bigint) as n_values, round(avg(l_extendedprice), 4) as mean_value "
    "from lineitem group by 1",
)
def _(spark, sf_dir):
    return rounded(
        agg.group_stats(read(spark, sf_dir, "lineitem"), "l_suppkey", "l_extendedprice"), ["mean_value"], 4
    )


def _pivot_sql(carriers) -> str:
    rules = [(k, f"op_carrier = '{k}'") for k in carriers]
    listed = ", ".join(f"'{k}'" for k in carriers)
    rules.append(("other", f"op_carrier is null or op_carrier not in ({listed})"))
    means = ", ".join(f"round(avg(dep_delay_new) filter (where {rule}), 6) as {name}" for name, rule in rules)
    return f"select origin, {means} from flights_v group by origin"


@query("mean_delay_pivot", with_flights(_pivot_sql(CARRIERS)))
def _(spark, sf_dir):
    return rounded(agg.mean_delay_pivot(flights_v(spark, sf_dir), CARRIERS), [*CARRIERS, "other"])


@query(
    "mean_delay_by_carrier",
    with_flights("select origin, op_carrier, round(avg(dep_delay_new), 6) as mean_delay from flights_v group by 1, 2"),
)
def _(spark, sf_dir):
    return rounded(agg.mean_delay_by_carrier(flights_v(spark, sf_dir)), ["mean_delay"])


_FEW = CARRIERS[:3]


@query("mean_delay_pivot_other", with_flights(_pivot_sql(_FEW)))
def _(spark, sf_dir):
    return rounded(agg.mean_delay_pivot(flights_v(spark, sf_dir), _FEW), [*_FEW, "other"])


@query("page_rows", with_flights(_pivot_sql(CARRIERS) + " order by origin limit 2 offset 1"))
def _(spark, sf_dir):
    matrix = agg.mean_delay_pivot(flights_v(spark, sf_dir), CARRIERS)
    return rounded(agg.page_rows(matrix, 1, 3, ["origin"]), [*CARRIERS, "other"])


@query(
    "page_rows_deep",
    "select l_shipdate, l_orderkey, l_linenumber, l_extendedprice from lineitem order by l_shipdate nulls first, "
    "l_orderkey nulls first, l_linenumber nulls first, l_extendedprice nulls first limit 20000 offset 4000",
)
def _(spark, sf_dir):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"]
    return agg.page_rows(spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*order), 4_000, 24_000, order)


@query(
    "delay_level_counts",
    with_flights("select op_carrier, case when dep_delay_new > 45 then 2 when dep_delay_new > 5 then 1 else 0 end "
                 "as level, cast(count(*) as bigint) as n_trips from flights_v group by 1, 2"),
)
def _(spark, sf_dir):
    return agg.delay_level_counts(flights_v(spark, sf_dir))


CORRELATED = ("dep_delay", "arr_delay", "carrier_delay", "taxi_out", "distance", "pred_delay")


def _correlation_sql(columns, source: str) -> str:
    cells = [
        f"select '{a}' as column_a, '{b}' as column_b, " +
        ("cast(1 as double)" if a == b else f"round(corr({a}, {b}), 6)") + f" as correlation from {source}"
        for a, b in product(columns, columns)
    ]
    one_row = [cell + (" having count(*) > 0" if "cast(1" in cell else "") for cell in cells]
    return " union all ".join(one_row)


@query("correlation_matrix", with_flights(_correlation_sql(CORRELATED, "flights_v")))
def _(spark, sf_dir):
    return rounded(agg.correlation_matrix(flights_v(spark, sf_dir), CORRELATED), ["correlation"])


@query(
    "correlation_matrix_filtered",
    with_flights(_correlation_sql(CORRELATED, "chosen_v"),
                 "chosen_v as (select * from flights_v where origin || '-' || dest like '%AP1%')"),
)
def _(spark, sf_dir):
    chosen = filters.filter_like(flights_v(spark, sf_dir), c.route("origin", "dest"), "%AP1%")
    return rounded(agg.correlation_matrix(chosen, CORRELATED), ["correlation"])


_WEATHER_PAIRS = ("dep_delay", "arr_delay", "dep_avg_temp_f", "dep_avg_vis_m", "arr_avg_temp_f", "arr_avg_slp_hpa")


@query("correlation_matrix_enriched", with_both(_correlation_sql(_WEATHER_PAIRS, "enriched_v"), *ENRICHED_CTES))
def _(spark, sf_dir):
    return rounded(agg.correlation_matrix(inputs.enriched(spark, sf_dir), _WEATHER_PAIRS), ["correlation"])


@query(
    "exploration_base",
    with_flights(
        "select origin || '-' || dest || '_' || cast(fl_date as varchar) as uni_id, flight_id, fl_date, "
        + ", ".join(f"coalesce({z}, 0) as {z}" for z in ZERO_FILLED)
        + " from flights_v where cancelled = 0 and dest_state_abr is not null and (origin = 'AP1' or dest = 'AP1') "
        "and fl_date >= date '2024-01-01' and fl_date < date '2024-01-21'"
    ),
)
def _(spark, sf_dir):
    rows = exploration_base(flights_v(spark, sf_dir), PARAMS)
    named = rows.select(
        c.trip_id(c.route("origin", "dest"), "fl_date").alias("uni_id"), "flight_id", "fl_date", *ZERO_FILLED
    )
    return fill_nulls(named, dict.fromkeys(ZERO_FILLED, 0))


@query(
    "date_bounds_by_catalog",
    with_flights("select min(fl_date) as min_date, max(fl_date) as max_date from flights_v"),
)
def _(spark, sf_dir):
    rows = flights_v(spark, sf_dir).select("flight_id", "fl_date")
    publish_table(rows, "ontime_bounds", stage_path(spark, "table"), partition_by=("fl_date",))
    return agg.date_bounds(partition_values(spark, "ontime_bounds", "fl_date"))


@query("date_bounds", with_flights("select min(fl_date) as min_date, max(fl_date) as max_date from flights_v"))
def _(spark, sf_dir):
    return agg.date_bounds(flights_v(spark, sf_dir))


@query("row_count", with_flights("select cast(count(*) as bigint) as n_rows from completed_v", COMPLETED_CTE))
def _(spark, sf_dir):
    return agg.row_count(inputs.completed(spark, sf_dir))


# DuckDB's columns(...) counts every column under its own name
@query("non_null_counts", with_flights(r"""select count(columns('(.*)')) as "\1" from flights_v"""))
def _(spark, sf_dir):
    return agg.non_null_counts(flights_v(spark, sf_dir))


@query("distinct_values", with_flights("select distinct tail_num from flights_v"))
def _(spark, sf_dir):
    return agg.distinct_values(flights_v(spark, sf_dir), "tail_num")


_METRICS = ["mse", "rmse", "mae", "r2"]


def _metrics_sql(keys: str = "") -> str:
    group = f" group by {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return (
        f"select {lead}cast(count(*) as bigint) as n_rows, "
        "round(avg(power(arr_delay - pred_delay, 2)), 6) as mse, "
        "round(sqrt(avg(power(arr_delay - pred_delay, 2))), 6) as rmse, "
        "round(avg(abs(arr_delay - pred_delay)), 6) as mae, "
        "round(1 - sum(power(arr_delay - pred_delay, 2)) / (var_pop(arr_delay) * count(*)), 6) as r2 "
        f"from flights_v where arr_delay is not null and pred_delay is not null{group}"
    )


@query("regression_metrics", with_flights(_metrics_sql()))
def _(spark, sf_dir):
    return rounded(agg.regression_metrics(flights_v(spark, sf_dir), "arr_delay", "pred_delay"), _METRICS)


@query("regression_metrics_by_carrier", with_flights(_metrics_sql("op_carrier")))
def _(spark, sf_dir):
    metrics = agg.regression_metrics(flights_v(spark, sf_dir), "arr_delay", "pred_delay", ["op_carrier"])
    return rounded(metrics, _METRICS)


@query(
    "order_desc",
    with_flights("select origin, cast(count(*) as bigint) as n_trips from flights_v group by 1 order by 2 desc, 1"),
)
def _(spark, sf_dir):
    counts = flights_v(spark, sf_dir).groupBy("origin").agg(F.count(F.lit(1)).alias("n_trips"))
    return agg.order_desc(counts, "n_trips", ("origin",))


@query(
    "top_k",
    "select l_suppkey, cast(count(*) as bigint) as n_lines from lineitem group by 1 order by 2 desc, 1 limit 50",
)
def _(spark, sf_dir):
    counts = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_lines"))
    return agg.top_k(counts, "n_lines", 50, ("l_suppkey",))


@query(
    "best_run",
    with_flights(
        "select run_id, rmse from (select substr(md5(op_carrier), 1, 10) as run_id, "
        "round(sqrt(avg(power(arr_delay - pred_delay, 2))), 6) as rmse from flights_v "
        "where arr_delay is not null group by op_carrier) runs order by rmse, run_id limit 1"
    ),
)
def _(spark, sf_dir):
    metrics = agg.regression_metrics(flights_v(spark, sf_dir), "arr_delay", "pred_delay", ["op_carrier"])
    runs = rounded(metrics.select(c.run_id("op_carrier").alias("run_id"), "rmse"), ["rmse"])
    return best_run(runs)


# Profiles and rules --------------------------------------------------------------------------------------------------

PROFILED = {
    "fl_date": "time", "op_carrier": "string", "tail_num": "string", "dest_state_abr": "string",
    "crs_dep_time": "int", "distance_group": "int", "origin_airport_id": "int", "distance": "float",
    "arr_delay": "float", "dep_delay": "float", "carrier_delay": "float",
}
_ROUNDED = ("mean", "stddev", "avg_length")


def _profile_sql(source: str, columns: dict[str, str]) -> str:
    def one(name: str, kind: str) -> str:
        number, text = kind in ("int", "float"), kind == "string"
        x = f"cast({name} as double)"

        def pick(flag: bool, expr: str, dtype: str = "double") -> str:
            return f"cast({expr} as {dtype})" if flag else f"cast(null as {dtype})"

        return (
            f"select '{name}' as column_name, '{kind}' as kind, cast(count(*) as bigint) as n_rows, "
            f"cast(count(*) - count({name}) as bigint) as n_missing, "
            f"{pick(number, f'round(avg({x}), 4)' if number else '0')} as mean, "
            f"{pick(number, f'round(stddev_pop({x}), 4)' if number else '0')} as stddev, "
            f"{pick(number, f'count(*) filter (where {x} = 0)' if number else '0', 'bigint')} as n_zeros, "
            f"{pick(number, f'min({x})' if number else '0')} as min_value, "
            f"{pick(number, f'quantile_disc({x}, 0.5)' if number else '0')} as median, "
            f"{pick(number, f'max({x})' if number else '0')} as max_value, "
            f"{pick(text, f'count(distinct {name})' if text else '0', 'bigint')} as n_distinct, "
            f"{pick(text, f'round(avg(length({name})), 4)' if text else '0')} as avg_length from {source}"
        )

    return " union all ".join(one(name, kind) for name, kind in columns.items())


def _ranges(spark, sf_dir):
    params = run_params(AIRPORT, "2024-01-01", "2024-01-20", "2024-01-30", airports=None)
    return validation_ranges(flights_v(spark, sf_dir).select(*PROFILED), params)


_TRAIN_CTE = "train_v as (select * from flights_v where fl_date between date '2024-01-01' and date '2024-01-20')"
_SERVE_CTE = "serve_v as (select * from flights_v where fl_date between date '2024-01-20' and date '2024-01-30')"
_TRAIN_PROFILE_CTE = f"train_profile_v as ({_profile_sql('train_v', PROFILED)})"
_SERVE_PROFILE_CTE = f"serve_profile_v as ({_profile_sql('serve_v', PROFILED)})"
_RULES_CTE = """rules_v as (
 select column_name, kind, n_missing = 0 as required, case when n_missing = 0 then 1.0 else 0.0 end::double
  as min_presence, kind = 'string' as has_domain from train_profile_v)"""
_RULE_CTES = (_TRAIN_CTE, _TRAIN_PROFILE_CTE, _RULES_CTE)


@query("column_profile", with_flights(_profile_sql("flights_v", PROFILED)))
def _(spark, sf_dir):
    profile = quality.column_profile(flights_v(spark, sf_dir), list(PROFILED))
    return rounded(profile, _ROUNDED, 4)


@query(
    "value_histogram",
    with_flights(
        "select bin, round(lo + bin * w, 6) as bin_start, round(lo + (bin + 1) * w, 6) as bin_end, "
        "cast(count(*) as bigint) as n_rows from (select lo, (hi - lo) / 20 as w, "
        "least(cast(floor((distance - lo) * 20 / (hi - lo)) as int), 19) as bin from flights_v, "
        "(select min(distance) as lo, max(distance) as hi from flights_v) b) t group by bin, lo, w"
    ),
)
def _(spark, sf_dir):
    bins = quality.value_histogram(flights_v(spark, sf_dir), "distance", 20)
    return rounded(bins, ["bin_start", "bin_end"])


@query(
    "top_values",
    with_flights("select tail_num, cast(count(*) as bigint) as n_rows from flights_v where tail_num is not null "
                 "group by 1 order by 2 desc, 1 limit 10"),
)
def _(spark, sf_dir):
    return quality.top_values(flights_v(spark, sf_dir), "tail_num", 10)


@query(
    "top_values_by_bucket",
    "select l_partkey, cast(count(*) as bigint) as n_rows from lineitem where l_partkey is not null "
    "group by 1 order by 2 desc, 1 limit 100",
)
def _(spark, sf_dir):
    return quality.top_values(read(spark, sf_dir, "lineitem"), "l_partkey", 100, buckets=65_536)


@query("infer_expectations", with_flights("select * from rules_v", *_RULE_CTES))
def _(spark, sf_dir):
    train, _serve = _ranges(spark, sf_dir)
    return quality.infer_expectations(quality.column_profile(train, median=None))


_DOMAINS = " union all ".join(
    f"select distinct '{n}' as column_name, {n} as value from train_v where {n} is not null and "
    f"(select has_domain from rules_v where column_name = '{n}')"
    for n, kind in PROFILED.items() if kind == "string"
)


@query("infer_domains", with_flights(_DOMAINS, *_RULE_CTES))
def _(spark, sf_dir):
    train, _serve = _ranges(spark, sf_dir)
    return quality.infer_domains(train, quality.infer_expectations(quality.column_profile(train, median=None)))


@query(
    "environment_rules",
    with_flights(
        "select column_name, kind, required and column_name not in ('arr_delay', 'dep_delay', 'distance') as required, "
        "case when column_name in ('arr_delay', 'dep_delay', 'distance') then 0.0 else min_presence end as min_presence, "
        "has_domain from rules_v", *_RULE_CTES,
    ),
)
def _(spark, sf_dir):
    train, _serve = _ranges(spark, sf_dir)
    rules = quality.infer_expectations(quality.column_profile(train, median=None))
    return quality.environment_rules(rules, ["arr_delay", "dep_delay", "distance"])


# A serving table with one anomaly of each kind: a column more, one less, a changed type, new gaps, a new carrier.
_ODD_CTE = """odd_v as (
 select fl_date, case when op_carrier = 'C6' then 'C9' else op_carrier end as op_carrier, tail_num, dest_state_abr,
  cast(crs_dep_time as varchar) as crs_dep_time, distance_group,
  case when dest_state_abr is not null then distance end as distance, carrier_delay, 'G1' as gate
 from serve_v)"""
_ODD_COLUMNS = {
    "fl_date": "time", "op_carrier": "string", "tail_num": "string", "dest_state_abr": "string",
    "crs_dep_time": "string", "distance_group": "int", "distance": "float", "carrier_delay": "float", "gate": "string",
}


def _odd(serve):
    return serve.select(
        "fl_date",
        F.when(F.col("op_carrier") == "C6", "C9").otherwise(F.col("op_carrier")).alias("op_carrier"),
        "tail_num",
        "dest_state_abr",
        F.col("crs_dep_time").cast("string").alias("crs_dep_time"),
        "distance_group",
        F.when(F.col("dest_state_abr").isNotNull(), F.col("distance")).alias("distance"),
        "carrier_delay",
        F.lit("G1").alias("gate"),
    )


_UNSEEN_CTE = f"""domains_v as ({_DOMAINS}), unseen_v as (
 select column_name, value, cast(count(*) as bigint) as n_rows from (
  select 'op_carrier' as column_name, op_carrier as value from odd_v
  union all select 'tail_num', tail_num from odd_v
  union all select 'dest_state_abr', dest_state_abr from odd_v) v
 where value is not null and column_name in (select column_name from domains_v)
  and (column_name, value) not in (select column_name, value from domains_v)
 group by 1, 2)"""


def _rules_and_unseen(spark, sf_dir):
    train, serve = _ranges(spark, sf_dir)
    odd = _odd(serve)
    rules = stage_table(quality.infer_expectations(quality.column_profile(train, median=None)))
    return odd, rules, quality.unseen_values(odd, quality.infer_domains(train, rules))


@query("unseen_values", with_flights("select * from unseen_v", *_RULE_CTES, _SERVE_CTE, _ODD_CTE, _UNSEEN_CTE))
def _(spark, sf_dir):
    return _rules_and_unseen(spark, sf_dir)[2]


_ANOMALIES_SQL = """
select p.column_name, 'new_column' as anomaly, p.kind as observed, cast(null as varchar) as expected
 from odd_profile_v p where p.column_name not in (select column_name from rules_v)
union all
select r.column_name, 'missing_column', null, r.kind from rules_v r
 where r.required and r.column_name not in ('arr_delay', 'dep_delay')
  and r.column_name not in (select column_name from odd_profile_v)
union all
select p.column_name, 'type_change', p.kind, r.kind from odd_profile_v p join rules_v r
 on r.column_name = p.column_name where p.kind <> r.kind
union all
select p.column_name, 'low_presence', cast(round((n_rows - n_missing) / n_rows, 6) as varchar),
 cast(round(r.min_presence, 6) as varchar) from odd_profile_v p join rules_v r on r.column_name = p.column_name
 where (n_rows - n_missing) / n_rows < r.min_presence
union all
select column_name, 'unseen_category', cast(count(*) as varchar), '0' from unseen_v group by 1"""


@query(
    "validate_profile",
    with_flights(_ANOMALIES_SQL, *_RULE_CTES, _SERVE_CTE, _ODD_CTE, _UNSEEN_CTE,
                 f"odd_profile_v as ({_profile_sql('odd_v', _ODD_COLUMNS)})"),
)
def _(spark, sf_dir):
    odd, rules, unseen = _rules_and_unseen(spark, sf_dir)
    return quality.validate_profile(quality.column_profile(odd, median=None), quality.environment_rules(rules), unseen)


_COMPARED = ("column_name", "serve_n_rows", "train_n_rows", "serve_mean", "train_mean", "mean_change",
             "median_change", "missing_change")


@query(
    "compare_profiles",
    with_flights(
        "select t.column_name, s.n_rows as serve_n_rows, t.n_rows as train_n_rows, s.mean as serve_mean, "
        "t.mean as train_mean, round(s.mean - t.mean, 3) as mean_change, round(s.median - t.median, 6) as median_change, "
        "round(s.n_missing / s.n_rows - t.n_missing / t.n_rows, 6) as missing_change "
        "from train_profile_v t join serve_profile_v s on s.column_name = t.column_name",
        _TRAIN_CTE, _SERVE_CTE, _TRAIN_PROFILE_CTE, _SERVE_PROFILE_CTE,
    ),
)
def _(spark, sf_dir):
    train, serve = _ranges(spark, sf_dir)
    profiles = [rounded(quality.column_profile(part), _ROUNDED, 4) for part in (serve, train)]
    compared = quality.compare_profiles(*profiles).select(*_COMPARED)
    return rounded(rounded(compared, ["median_change", "missing_change"]), ["mean_change"], 3)


DRIFTING = ("crs_dep_time", "distance", "arr_delay", "carrier_delay", "day_of_month")
_BINS = 20


def _drift_ctes(columns=DRIFTING) -> list[str]:
    both = "select *, 1 as s from serve_v union all select *, 0 as s from train_v"
    binned = " union all ".join(
        f"select '{x}' as column_name, s, coalesce(least(cast(floor((cast({x} as double) - lo) * {_BINS} "
        f"/ nullif(hi - lo, 0)) as int), {_BINS - 1}), 0) as bin from both_v, "
        f"(select cast(min({x}) as double) as lo, cast(max({x}) as double) as hi from both_v) b where {x} is not null"
        for x in columns
    )
    return [
        _TRAIN_CTE, _SERVE_CTE, f"both_v as ({both})", f"binned_v as ({binned})",
        "counts_v as (select column_name, bin, sum(s) as n_serve, sum(1 - s) as n_train from binned_v group by 1, 2)",
        "shares_v as (select column_name, bin, "
        "cast(n_serve as double) / sum(n_serve) over (partition by column_name) as p, "
        "cast(n_train as double) / sum(n_train) over (partition by column_name) as q from counts_v)",
        "gaps_v as (select *, abs(sum(p) over w - sum(q) over w) as gap from shares_v "
        "window w as (partition by column_name order by bin rows between unbounded preceding and current row))",
        "drift_v as (select column_name, max(gap) as ks, max(abs(p - q)) as l_infinity, "
        "sum(case when p > 0 then p * log2(p / ((p + q) / 2)) / 2 else 0 end "
        "+ case when q > 0 then q * log2(q / ((p + q) / 2)) / 2 else 0 end) as js from gaps_v group by 1)",
    ]


def _drift(spark, sf_dir):
    params = run_params(AIRPORT, "2024-01-01", "2024-01-20", "2024-01-30", airports=None)
    train, serve = validation_ranges(flights_v(spark, sf_dir), params)
    return quality.drift_distance(serve, train, DRIFTING, _BINS)


@query(
    "drift_distance",
    with_flights("select column_name, round(ks, 6) as ks, round(l_infinity, 6) as l_infinity, round(js, 6) as js "
                 "from drift_v", *_drift_ctes()),
)
def _(spark, sf_dir):
    return rounded(_drift(spark, sf_dir), ["ks", "l_infinity", "js"])


@query(
    "retrain_signal",
    with_flights(
        "select coalesce(bool_or(ks > 0.02), false) as retrain, "
        "cast(count(*) filter (where ks > 0.02) as bigint) as n_drifted, "
        "arg_max(column_name, ks) as worst_column from drift_v "
        "where column_name not in ('day_of_month', 'arr_delay', 'dep_delay')", *_drift_ctes(),
    ),
)
def _(spark, sf_dir):
    return quality.retrain_signal(_drift(spark, sf_dir), 0.02)


@query(
    "reconcile_counts",
    with_flights(
        "select e.n as expected_rows, a.n as actual_rows, e.d as expected_max_date, a.d as actual_max_date, "
        "e.n = a.n and e.d = a.d as agree from "
        "(select cast(count(*) as bigint) as n, max(fl_date) as d from flights_v where fl_date = date '2024-01-21') e, "
        "(select cast(count(*) as bigint) as n, max(fl_date) as d from flights_v where fl_date = date '2024-01-21' "
        "and arr_delay is not null) a"
    ),
)
def _(spark, sf_dir):
    _, serve = serving_split(flights_v(spark, sf_dir), PARAMS)
    return quality.reconcile_counts(serve, serve.where(F.col("arr_delay").isNotNull()))


# The same over every column of the table ------------------------------------------------------------------------------

ALL_COLUMNS = {
    "fl_date": "time",
    **dict.fromkeys(("tail_num", "op_carrier", "op_unique_carrier", "origin", "dest", "origin_city_name", "dest_city_name",
                     "origin_state_abr", "dest_state_abr", "dep_time_blk", "arr_time_blk"), "string"),
    **dict.fromkeys(("flight_id", "year", "quarter", "month", "day_of_month", "day_of_week", "op_carrier_fl_num",
                     "origin_airport_id", "dest_airport_id", "origin_airport_seq_id", "crs_dep_time", "crs_arr_time",
                     "crs_elapsed_time", "arr_del15", "dep_del15", "cancelled", "diverted", "distance_group"), "int"),
    **dict.fromkeys(("dep_delay", "arr_delay", "dep_delay_new", "arr_delay_new", "carrier_delay", "weather_delay",
                     "nas_delay", "security_delay", "late_aircraft_delay", "taxi_out", "taxi_in", "wheels_off",
                     "wheels_on", "actual_elapsed_time", "air_time", "pred_delay", "distance"), "float"),
}
ALL_DOUBLES = tuple(n for n, kind in ALL_COLUMNS.items() if kind == "float")
ALL_NUMBERS = tuple(n for n, kind in ALL_COLUMNS.items() if kind in ("int", "float"))
_SILVER_DOUBLES = tuple(n for n in ALL_DOUBLES if n not in ("nas_delay", "air_time", "pred_delay"))
ALL_ENRICHED = (*_SILVER_DOUBLES, *(f"{side}_{m}" for side in ("dep", "arr") for m in MEASURES))


def _all_pairs_sql(columns, source: str) -> str:
    """One scan for all pairs."""
    cells = ", ".join(
        f"{{'column_a': '{a}', 'column_b': '{b}', 'correlation': "
        + (f"case when var_pop({a}) > 0 then cast(1 as double) end" if a == b else f"round(corr({a}, {b}), 6)") + "}"
        for a, b in product(columns, columns)
    )
    return f"select unnest([{cells}], recursive := true) from {source}"


def _correlations(df):
    return rounded(agg.correlation_matrix(df, filters.numeric_columns(df)), ["correlation"])


@query("correlation_matrix_all", with_flights(_all_pairs_sql(ALL_DOUBLES, "flights_v")))
def _(spark, sf_dir):
    return _correlations(flights_v(spark, sf_dir))


@query(
    "correlation_matrix_filtered_all",
    with_flights(_all_pairs_sql(ALL_DOUBLES, "chosen_v"),
                 "chosen_v as (select * from flights_v where origin || '-' || dest like '%AP1%')"),
)
def _(spark, sf_dir):
    return _correlations(filters.filter_like(flights_v(spark, sf_dir), c.route("origin", "dest"), "%AP1%"))


@query("correlation_matrix_enriched_all", with_both(_all_pairs_sql(ALL_ENRICHED, "enriched_v"), *ENRICHED_CTES))
def _(spark, sf_dir):
    return _correlations(inputs.enriched(spark, sf_dir))


_ALL_TRAIN_CTE = f"train_profile_v as ({_profile_sql('train_v', ALL_COLUMNS)})"
_ALL_RULE_CTES = (_TRAIN_CTE, _ALL_TRAIN_CTE, _RULES_CTE)


def _all_ranges(spark, sf_dir):
    params = run_params(AIRPORT, "2024-01-01", "2024-01-20", "2024-01-30", airports=None)
    return validation_ranges(flights_v(spark, sf_dir), params)


@query("column_profile_all", with_flights(_profile_sql("flights_v", ALL_COLUMNS)))
def _(spark, sf_dir):
    return rounded(quality.column_profile(flights_v(spark, sf_dir)), _ROUNDED, 4)


@query("infer_expectations_all", with_flights("select * from rules_v", *_ALL_RULE_CTES))
def _(spark, sf_dir):
    train, _serve = _all_ranges(spark, sf_dir)
    return quality.infer_expectations(quality.column_profile(train, median=None))


@query(
    "compare_profiles_all",
    with_flights(
        "select t.column_name, s.n_rows as serve_n_rows, t.n_rows as train_n_rows, s.mean as serve_mean, "
        "t.mean as train_mean, round(s.mean - t.mean, 3) as mean_change, round(s.median - t.median, 6) as median_change, "
        "round(s.n_missing / s.n_rows - t.n_missing / t.n_rows, 6) as missing_change "
        "from train_profile_v t join serve_profile_v s on s.column_name = t.column_name",
        _TRAIN_CTE, _SERVE_CTE, _ALL_TRAIN_CTE, f"serve_profile_v as ({_profile_sql('serve_v', ALL_COLUMNS)})",
    ),
)
def _(spark, sf_dir):
    train, serve = _all_ranges(spark, sf_dir)
    profiles = [rounded(quality.column_profile(part), _ROUNDED, 4) for part in (serve, train)]
    compared = quality.compare_profiles(*profiles).select(*_COMPARED)
    return rounded(rounded(compared, ["median_change", "missing_change"]), ["mean_change"], 3)


_STRINGS = [n for n, kind in ALL_COLUMNS.items() if kind == "string"]
_ALL_ODD_CTE = """odd_v as (
 select * exclude (origin_airport_id) replace (
  case when op_carrier = 'C6' then 'C9' else op_carrier end as op_carrier,
  cast(crs_dep_time as varchar) as crs_dep_time, case when dest_state_abr is not null then distance end as distance),
  'G1' as gate from serve_v)"""
_ALL_ODD_COLUMNS = {
    **{n: kind for n, kind in ALL_COLUMNS.items() if n != "origin_airport_id"}, "crs_dep_time": "string", "gate": "string",
}
_ALL_UNSEEN_CTE = "domains_v as (" + " union all ".join(
    f"select distinct '{n}' as column_name, {n} as value from train_v where {n} is not null and "
    f"(select has_domain from rules_v where column_name = '{n}')" for n in _STRINGS
) + "), unseen_v as (select column_name, value, cast(count(*) as bigint) as n_rows from (" + " union all ".join(
    f"select '{n}' as column_name, {n} as value from odd_v" for n in _STRINGS
) + """) v where value is not null and column_name in (select column_name from domains_v)
 and (column_name, value) not in (select column_name, value from domains_v) group by 1, 2)"""


@query(
    "validate_profile_all",
    with_flights(_ANOMALIES_SQL, *_ALL_RULE_CTES, _SERVE_CTE, _ALL_ODD_CTE, _ALL_UNSEEN_CTE,
                 f"odd_profile_v as ({_profile_sql('odd_v', _ALL_ODD_COLUMNS)})"),
)
def _(spark, sf_dir):
    train, serve = _all_ranges(spark, sf_dir)
    odd = serve.drop("origin_airport_id").withColumns({
        "op_carrier": F.when(F.col("op_carrier") == "C6", "C9").otherwise(F.col("op_carrier")),
        "crs_dep_time": F.col("crs_dep_time").cast("string"),
        "distance": F.when(F.col("dest_state_abr").isNotNull(), F.col("distance")),
        "gate": F.lit("G1"),
    })
    rules = stage_table(quality.infer_expectations(quality.column_profile(train, median=None)))
    unseen = quality.unseen_values(odd, quality.infer_domains(train, rules))
    return quality.validate_profile(quality.column_profile(odd, median=None), quality.environment_rules(rules), unseen)


def _all_drift(spark, sf_dir):
    train, serve = _all_ranges(spark, sf_dir)
    numbers = filters.numeric_columns(serve, (NumericType,))
    return quality.drift_distance(serve, train, numbers, _BINS)


@query(
    "drift_distance_all",
    with_flights("select column_name, round(ks, 6) as ks, round(l_infinity, 6) as l_infinity, round(js, 6) as js "
                 "from drift_v", *_drift_ctes(ALL_NUMBERS)),
)
def _(spark, sf_dir):
    return rounded(_all_drift(spark, sf_dir), ["ks", "l_infinity", "js"])


CODES = ("origin_airport_id", "dest_airport_id", "distance_group")
VALUE_COLUMNS = tuple(n for n, kind in ALL_COLUMNS.items() if kind == "string" or n in CODES)


def _value_counts_sql(columns, kind: str) -> str:
    known = "and not isnan(cast({x} as double))" if kind == "double" else ""
    return " union all ".join(
        f"select '{x}' as column_name, cast({x} as {kind}) as v, sum(s) as n_serve, sum(1 - s) as n_train from both_v "
        f"where {x} is not null {known.format(x=x)} group by 2" for x in columns
    )


def _unbinned_ctes(columns, kind: str) -> list[str]:
    return [
        _TRAIN_CTE, _SERVE_CTE, "both_v as (select *, 1 as s from serve_v union all select *, 0 as s from train_v)",
        f"counts_v as ({_value_counts_sql(columns, kind)})",
        "shares_v as (select *, cast(n_serve as double) / nullif(sum(n_serve) over (partition by column_name), 0) as p, "
        "cast(n_train as double) / nullif(sum(n_train) over (partition by column_name), 0) as q from counts_v)",
    ]


@query(
    "value_drift",
    with_flights(
        "select column_name, count(*) as n_values, count(*) filter (where n_train = 0) as n_new, "
        "round(max(abs(p - q)), 6) as l_infinity, "
        "first(v order by -round(abs(p - q), 12), v) filter (where abs(p - q) is not null) as worst_value, "
        "case when max(abs(p - q)) is not null then "
        "round(sum(case when p > 0 then p * log2(p / ((p + q) / 2)) / 2 else 0 end "
        "+ case when q > 0 then q * log2(q / ((p + q) / 2)) / 2 else 0 end), 6) end as js from shares_v group by 1",
        *_unbinned_ctes(VALUE_COLUMNS, "varchar"),
    ),
)
def _(spark, sf_dir):
    train, serve = _all_ranges(spark, sf_dir)
    return rounded(drift.value_drift(serve, train, VALUE_COLUMNS), ["l_infinity", "js"])


@query(
    "exact_ks",
    with_flights(
        "select column_name, round(max(gap), 6) as ks from (select column_name, abs(sum(p) over w - sum(q) over w) as gap "
        "from shares_v window w as (partition by column_name order by v rows between unbounded preceding and current row)) "
        "group by 1", *_unbinned_ctes(ALL_NUMBERS, "double"),
    ),
)
def _(spark, sf_dir):
    train, serve = _all_ranges(spark, sf_dir)
    return rounded(drift.exact_ks(serve, train, ALL_NUMBERS), ["ks"])


@query(
    "retrain_signal_all",
    with_flights(
        "select coalesce(bool_or(ks > 0.02), false) as retrain, "
        "cast(count(*) filter (where ks > 0.02) as bigint) as n_drifted, "
        "arg_max(column_name, ks) as worst_column from drift_v "
        "where column_name not in ('year', 'quarter', 'month', 'day_of_month', 'day_of_week', 'arr_delay', 'dep_delay')", *_drift_ctes(ALL_NUMBERS),
    ),
)
def _(spark, sf_dir):
    return quality.retrain_signal(_all_drift(spark, sf_dir), 0.02)


# Graph ---------------------------------------------------------------------------------------------------------------


@query(
    "build_graph",
    with_flights(
        "select origin_airport_seq_id as trip_id, dep_delay as delay, origin as src, dest as dst, "
        "split_part(dest_city_name, ',', 1) as city_dst, dest_state_abr as state_dst from flights_v"
    ),
)
def _(spark, sf_dir):
    return graph.build_graph(flights_v(spark, sf_dir))[1]


@query("build_graph_vertices", with_flights("select distinct origin as id from flights_v"))
def _(spark, sf_dir):
    return graph.build_graph(flights_v(spark, sf_dir))[0]


@query(
    "edge_query",
    with_flights("select split_part(dest_city_name, ',', 1) as city_dst, cast(count(dep_delay) as bigint) as n_delayed "
                 "from flights_v where origin = 'AP1' and dep_delay > 0 group by 1"),
)
def _(spark, sf_dir):
    _, edges = graph.build_graph(flights_v(spark, sf_dir))
    return graph.edge_query(edges, "src", AIRPORT, ["city_dst"], F.count("delay").alias("n_delayed"))


def _pagerank_ctes(edges: str, vertices: str, reset: float = 0.15, iters: int = 5) -> list[str]:
    ctes = [
        f"vertex_v as ({vertices})",
        f"edge_v as (select src, dst from ({edges}) e where src in (select id from vertex_v) "
        "and dst in (select id from vertex_v))",
        "weight_v as (select src, dst, cast(count(*) as double) / max(d) as weight from edge_v "
        "join (select src, count(*) as d from edge_v group by src) o using (src) group by src, dst)",
        "rank_0 as (select id, cast(1 as double) as r from vertex_v)",
    ]
    for i in range(1, iters + 1):
        ctes.append(
            f"rank_{i} as (select v.id, {reset} + {1 - reset} * coalesce(sum(r.r * w.weight), 0) as r from vertex_v v "
            f"left join weight_v w on w.dst = v.id left join rank_{i - 1} r on r.id = w.src group by v.id)"
        )
    ctes.append(
        f"pagerank_v as (select id, r * (select count(*) / sum(r) from rank_{iters}) as pagerank from rank_{iters})"
    )
    return ctes


@query(
    "pagerank",
    with_flights(
        "select id, round(pagerank, 6) as pagerank from pagerank_v",
        *_pagerank_ctes("select origin as src, dest as dst from flights_v", "select distinct origin as id from flights_v"),
    ),
)
def _(spark, sf_dir):
    return rounded(graph.pagerank(*graph.build_graph(flights_v(spark, sf_dir))), ["pagerank"])


# Routes between parts and suppliers: many vertices, sinks included.
_TRADE_EDGES = (
    "select 's' || cast(l_suppkey as varchar) as src, 'o' || cast(l_partkey as varchar) as dst from lineitem "
    "union all select 'o' || cast(l_partkey as varchar), 's' || cast(l_suppkey as varchar) from lineitem "
    "where l_returnflag = 'R'"
)
_TRADE_VERTICES = (
    "select distinct 's' || cast(l_suppkey as varchar) as id from lineitem "
    "union all select distinct 'o' || cast(l_partkey as varchar) from lineitem"
)


@query(
    "pagerank_top_k",
    "with " + ", ".join(_pagerank_ctes(_TRADE_EDGES, _TRADE_VERTICES))
    + " select id, round(pagerank, 6) as pagerank from pagerank_v order by 2 desc, 1 limit 50",
)
def _(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("supplier"),
        F.concat(F.lit("o"), F.col("l_partkey").cast("string")).alias("part"),
        "l_returnflag",
    )
    sold = lines.select(F.col("supplier").alias("src"), F.col("part").alias("dst"))
    returned = lines.where("l_returnflag = 'R'").select(F.col("part").alias("src"), F.col("supplier").alias("dst"))
    vertices = lines.select(F.explode(F.array("supplier", "part")).alias("id")).distinct()
    ranks = rounded(graph.pagerank(vertices, sold.unionByName(returned)), ["pagerank"])
    return agg.top_k(ranks, "pagerank", 50, ("id",))
