"""Joins with weather, predictions and code tables.

No side is hinted as small: the optimizer broadcasts a side only when its known size is below
``spark.sql.autoBroadcastJoinThreshold`` (adaptive execution checks again with the measured size) and otherwise
sort-merges, with skewed partitions split at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.functions.columns import lookup


def attach_weather(
    trips: DataFrame,
    weather: DataFrame,
    hour: str,
    code: str,
    prefix: str,
    how: str = "inner",
    salt: int = 1,
) -> DataFrame:
    """Equi-join on (hour, station code) with the measures prefixed.

    ``salt`` > 1 spreads the trips of one hot (hour, code) over that many tasks: the hourly table, which has one row
    per key, is repeated once per salt value.
    """
    measures = [c for c in weather.columns if c not in ("time", "code")]
    side = weather.select(
        F.col("time").alias(hour), F.col("code").alias(code), *[F.col(m).alias(prefix + m) for m in measures]
    )
    left, keys = trips, [hour, code]
    if salt > 1:
        left = left.withColumn("_salt", F.pmod(F.xxhash64(*trips.columns), F.lit(salt)).cast("int"))
        side = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        keys = [*keys, "_salt"]
    return left.join(side, keys, how).select(*trips.columns, *[prefix + m for m in measures])


def enrich_departure(trips: DataFrame, weather: DataFrame, how: str = "inner", salt: int = 1) -> DataFrame:
    """Weather at the origin in the scheduled departure hour; with an inner join trips without weather vanish."""
    return attach_weather(trips, weather, "dep_time", "origin", "dep_", how, salt)


def enrich_arrival(trips: DataFrame, weather: DataFrame, how: str = "inner", salt: int = 1) -> DataFrame:
    """Weather at the destination in the (rolled) scheduled arrival hour."""
    return attach_weather(trips, weather, "arr_time", "dest", "arr_", how, salt)


def attach_predictions(ids: DataFrame, predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Predictions next to their identifying columns, matched by key rather than by position."""
    return ids.join(predictions, list(keys), "inner")


def align_actuals(actual: DataFrame, predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Predictions next to the actual values; rows without a prediction keep NULL."""
    return actual.join(predictions, list(keys), "left")


def decode_codes(
    df: DataFrame,
    code: str,
    names: DataFrame | Mapping[str, str],
    output: str,
    dim_code: str = "code",
    dim_name: str = "name",
) -> DataFrame:
    """Display name of a code: a map literal for a fixed table, a left join for a dimension unique on its code."""
    if isinstance(names, Mapping):
        return df.withColumn(output, lookup(code, dict(names)))
    dim = names.select(F.col(dim_code).alias(code), F.col(dim_name).alias(output))
    return df.join(dim, code, "left").select(*df.columns, output)
