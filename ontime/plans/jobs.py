"""The jobs in order: build the enriched table, train, score, check, show the boards.

Stages hand over written tables, as separate cluster jobs would; each can run again on its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.operators import models, quality
from ontime.operators.aggregates import hourly_weather
from ontime.operators.ensembles import SavedModels
from ontime.operators.filters import drop_any_null, filter_dates, filter_endpoint, filter_not_cancelled, filter_not_null
from ontime.params import RunParams
from ontime.plans.board import arrival_board, departure_board
from ontime.plans.enriched import enriched_flights, serving_split, validation_ranges, weather_for
from ontime.plans.silver import silver_flights
from ontime.schema import ARRIVAL_FEATURES, DEPARTURE_FEATURES, FEATURE_SETS, PREDICTION_IDS
from ontime.sources.sinks import publish_predictions, publish_table, stage_table

TARGETS = {"arr": ("arr_delay", ARRIVAL_FEATURES), "dep": ("dep_delay", DEPARTURE_FEATURES)}


def etl_job(
    flights: DataFrame, weather: DataFrame, params: RunParams, table: str, path: str | None = None,
    tie: Sequence[str] = ("flight_id",), partition_by: Sequence[str] = ("fl_date",),
) -> DataFrame:
    """Publish the enriched table of one airport and period, by default in date partitions, which later jobs prune.

    The hourly weather is written once and read by both joins; being a written table, its size is known, so that the
    optimizer decides between broadcast and sort-merge join from a fact.
    """
    hourly = stage_table(hourly_weather(weather_for(weather, params)))
    silver = silver_flights(flights, params, tie=tie, keep=tie)
    enriched = enriched_flights(silver, hourly, keep=tie)
    return publish_table(enriched, table, path, partition_by=partition_by, stage_first=False)


@dataclass
class Trained:
    name: str
    path: str
    runs: DataFrame
    model: PipelineModel


def model_job(
    enriched: DataFrame, params: RunParams, target: str, candidates: Mapping[str, Sequence[Mapping[str, Any]]],
    model_dir: str, runs_path: str, key: str = "flight_id", features: str | Sequence[str] | None = None,
    missing: str = "zero",
) -> Trained:
    """Search over ``candidates`` (settings per model kind) for one target, log every run, save the best model.

    ``features``: columns, or the name of a list in ``FEATURE_SETS``; by default the target's own list. ``missing``:
    "zero" counts a missing or non-number feature as 0, "drop" leaves out the rows that have one.
    """
    label, own = TARGETS[target]
    features = FEATURE_SETS[features] if isinstance(features, str) else tuple(features or own)
    if missing not in ("zero", "drop"):
        raise ValueError(f"missing is 'zero' or 'drop', not {missing!r}")
    known, _ = serving_split(enriched, params)
    if missing == "drop":
        known = drop_any_null(known, (*features, label))
    staged = stage_table(known.select(*dict.fromkeys((key, *features, label))))
    train, test = models.split_train_test(staged, key)
    fitted, runs = SavedModels(), []
    for kind, settings in candidates.items():
        more_models, more_runs = models.grid_search(train, test, features, label, settings, kind, params.airport)
        fitted = fitted + more_models
        runs += more_runs
    spark = enriched.sparkSession
    log = models.log_runs(spark, runs, runs_path)
    name, path = models.select_and_save(spark, runs, fitted, model_dir, params.airport, target)
    return Trained(name, path, log, PipelineModel.load(path))


def scoring_job(
    enriched: DataFrame, params: RunParams, target: str, model_path: str, output_dir: str, key: str = "flight_id"
) -> tuple[DataFrame, DataFrame]:
    """Publish predictions for the inference date; returns them and their reconciliation with the input."""
    _, to_predict = serving_split(enriched, params)
    scored = models.score(model_path, to_predict, f"{target}_pred")
    columns = dict.fromkeys((key, "fl_date", *PREDICTION_IDS, f"{target}_pred"))
    out = scored.select(*columns, F.lit(params.airport).alias("airport"))
    written = publish_predictions(out, f"{output_dir.rstrip('/')}/{target}_pred")
    mine = written.where(F.col("airport") == params.airport)
    return mine, quality.reconcile_counts(to_predict, mine)


@dataclass
class Checked:
    anomalies: DataFrame
    comparison: DataFrame
    drift: DataFrame
    signal: DataFrame


def monitoring_job(
    df: DataFrame, params: RunParams, column: str = "fl_date", labels: Sequence[str] = quality.LABEL_COLUMNS,
    threshold: float = 0.2,
) -> Checked:
    """Profile the training and serving ranges, validate the latter against the former and measure the drift."""
    train, serve = validation_ranges(df, params, column)
    serve = serve.drop(*labels)
    train_profile = stage_table(quality.column_profile(train))
    serve_profile = stage_table(quality.column_profile(serve))
    rules = stage_table(quality.infer_expectations(train_profile))
    domains = stage_table(quality.infer_domains(train, rules))
    anomalies = quality.validate_profile(
        serve_profile, quality.environment_rules(rules, labels), quality.unseen_values(serve, domains)
    )
    drift = stage_table(quality.drift_distance(serve, train))
    return Checked(
        anomalies,
        quality.compare_profiles(serve_profile, train_profile),
        drift,
        quality.retrain_signal(drift, threshold),
    )


def boards(
    arrivals: DataFrame, departures: DataFrame, params: RunParams, as_of: datetime, status_rule: str = "reference"
) -> tuple[DataFrame, DataFrame]:
    return (
        arrival_board(arrivals, params.airport, as_of, status_rule=status_rule),
        departure_board(departures, params.airport, as_of, status_rule=status_rule),
    )


def exploration_base(flights: DataFrame, params: RunParams) -> DataFrame:
    """Trips to explore: not cancelled, known destination state, at the airport, in the period before inference."""
    kept = filter_not_null(filter_not_cancelled(flights), "dest_state_abr")
    at_airport = filter_endpoint(kept, params.airport)
    return filter_dates(at_airport, params.train_start, params.inference, closed="left")
