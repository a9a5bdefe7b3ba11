"""Column names, code tables and parameter grids fixed by the data model.

Spark resolves column names without regard to case, so the lower-case names work on upper-case source tables too.
"""

from __future__ import annotations

# --- Fixed values: names, codes and numbers a user's tables and runs already rely on. ---

AIRPORT_CODES = ("JFK", "SEA", "BOS", "ATL", "LAX", "SFO", "DEN", "DFW", "ORD", "CVG", "CLT", "DCA", "IAH")

STATION_NAMES = {
    "JFK": "JFK INTERNATIONAL AIRPORT",
    "BOS": "BOSTON",
    "ATL": "ATLANTA HARTSFIELD",
    "DFW": "DALLAS FORT WORTH",
    "ORD": "CHICAGO OHARE INTERNATIONAL AIRPORT",
    "CLT": "CHARLOTTE DOUGLAS AIRPORT",
    "DCA": "WASHINGTON REAGAN NATIONAL AIRPORT",
    "IAH": "HOUSTON INTERCONTINENTAL",
    "SEA": "SEATTLE",
    "LAX": "LOS ANGELES INTERNATIONAL AIRPORT",
    "SFO": "SAN FRANCISCO INTERNATIONAL AIRPORT",
    "DEN": "DENVER INTERNATIONAL AIRPORT",
    "CVG": "CINCINNATI NORTHERN KENTUCKY INTERNATIONAL AIRPORT",
    "BOI": "CALDWELL",
    "PSP": "DESERT RESORTS REGIONAL AIRPORT",
    "FAT": "MAMMOTH LAKES MAMMOTH YOSEMITE",
}

CITY_NAMES = {
    "DEN": "Denver",
    "CLT": "Charlotte",
    "SEA": "Seattle",
    "DFW": "Dallas Fort Worth",
    "ATL": "Atlanta",
    "LAX": "Los Angeles",
    "BOS": "Boston",
    "JFK": "New York",
    "IAH": "Houston",
    "DCA": "Washington",
    "ORD": "Chicago",
    "SFO": "San Francisco",
    "CVG": "Cincinnati",
}

CARRIER_NAMES = {
    "UA": "United Air Lines Inc.",
    "AA": "American Airlines Inc.",
    "US": "US Airways Inc.",
    "F9": "Frontier Airlines Inc.",
    "B6": "JetBlue Airways",
    "OO": "Skywest Airlines Inc.",
    "AS": "Alaska Airlines Inc.",
    "NK": "Spirit Air Lines",
    "WN": "Southwest Airlines Co.",
    "DL": "Delta Air Lines Inc.",
    "EV": "Atlantic Southeast Airlines",
    "HA": "Hawaiian Airlines Inc.",
    "MQ": "American Eagle Airlines Inc.",
    "VX": "Virgin America",
}

# Raw weather table.
WEATHER_COLUMNS = (
    "station", "date", "latitude", "longitude", "name", "report_type", "call_sign",
    "wnd", "cig", "vis", "tmp", "dew", "slp", "aa1", "aj1", "at1", "ga1", "ia1", "ma1", "md1", "oc1", "rem",
)

# Hourly weather measures.
MEASURES = ("avg_temp_f", "tot_precip_mm", "avg_wnd_mps", "avg_vis_m", "avg_slp_hpa", "avg_dewpt_f")

# Trip table after the silver step, before the two hour keys.
SILVER_COLUMNS = (
    "dep_delay", "arr_delay", "year", "quarter", "month", "day_of_month", "day_of_week", "fl_date", "fl_path",
    "op_unique_carrier", "tail_num", "op_carrier_fl_num", "origin", "origin_city_name", "origin_state_abr",
    "dest", "dest_city_name", "dest_state_abr", "crs_dep_time", "crs_dep_time_hour", "dep_time_hour",
    "dep_delay_new", "dep_time_blk", "crs_arr_time", "crs_arr_time_hour", "arr_time_hour", "arr_delay_new",
    "carrier_delay", "weather_delay", "security_delay", "late_aircraft_delay", "taxi_out", "wheels_off",
    "wheels_on", "taxi_in", "actual_elapsed_time", "arr_time_blk", "distance", "distance_group",
    "dep_del15", "arr_del15", "origin_airport_id", "dest_airport_id", "crs_dep_timestamp", "crs_arr_timestamp",
    "pr_arr_del15",
)

# Trip table after both weather joins.
ENRICHED_COLUMNS = (
    "dep_delay", "arr_delay", "year", "quarter", "month", "day_of_month", "day_of_week", "fl_date",
    "op_unique_carrier", "tail_num", "op_carrier_fl_num", "origin", "origin_city_name", "origin_state_abr",
    "dest", "dest_city_name", "dest_state_abr", "crs_dep_time", "crs_dep_time_hour", "dep_time_hour",
    "dep_delay_new", "dep_time_blk", "crs_arr_time", "crs_arr_time_hour", "arr_time_hour", "arr_delay_new",
    "arr_time_blk", "distance", "distance_group", "dep_del15", "arr_del15", "origin_airport_id",
    "dest_airport_id", "crs_dep_timestamp", "crs_arr_timestamp", "pr_arr_del15", "dep_time", "arr_time",
    "fl_path", "origin_city", "dest_city", "carrier_delay", "weather_delay", "security_delay",
    "late_aircraft_delay", "taxi_out", "wheels_off", "wheels_on", "taxi_in", "actual_elapsed_time",
    *(f"dep_{m}" for m in MEASURES),
    *(f"arr_{m}" for m in MEASURES),
)

# Delay causes that count as zero when absent.
ZERO_FILLED = ("arr_del15", "carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay")

# Identifying columns of a prediction row.
PREDICTION_IDS = (
    "tail_num", "op_carrier_fl_num", "origin", "origin_city_name", "dest", "dest_city_name",
    "crs_dep_timestamp", "crs_arr_timestamp",
)

# Model inputs.
_OPERATIONS = (
    "distance", "taxi_out", "wheels_off", "wheels_on", "taxi_in", "pr_arr_del15", "actual_elapsed_time",
    "carrier_delay", "weather_delay", "security_delay", "late_aircraft_delay",
)
_WEATHER_FEATURES = tuple(f"{side}_{m}" for side in ("dep", "arr") for m in MEASURES)
ARRIVAL_FEATURES = (*_OPERATIONS, "dep_delay_new", *_WEATHER_FEATURES)
DEPARTURE_FEATURES = (*_OPERATIONS, "arr_delay_new", *_WEATHER_FEATURES)
SCHEDULE_FEATURES = (
    "crs_dep_time", "crs_dep_time_hour", "crs_arr_time", "crs_arr_time_hour", "year", "quarter", "month",
    "day_of_month", "day_of_week", "distance", "distance_group", "origin_airport_id", "dest_airport_id",
    *_WEATHER_FEATURES,
)
LABELS = ("arr_delay", "dep_delay")

# Searched settings.
FOREST_GRID = {"num_trees": (100, 200, 500), "max_depth": (7, 10, 25), "feature_subset": ("auto", "sqrt")}
BOOSTING_GRID = {"num_trees": (100, 200, 300, 500), "max_depth": (10, 15, 20, 25), "feature_subset": ("sqrt",)}
SEARCH_SPACE = {"num_trees": (100, 200, 300, 400, 500), "max_depth": (5, 10, 15)}

# --- End of fixed values. ---

# Inputs known before the trip starts: the schedule list plus the flag of the previous leg.
PRE_DEPARTURE_FEATURES = (*SCHEDULE_FEATURES, "pr_arr_del15")

FEATURE_SETS = {
    "arrival": ARRIVAL_FEATURES,
    "departure": DEPARTURE_FEATURES,
    "schedule": SCHEDULE_FEATURES,
    "pre_departure": PRE_DEPARTURE_FEATURES,
}
