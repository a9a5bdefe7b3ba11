"""Column selection, renaming, filling, scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.functions.columns import null_nan


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def project_rename(df: DataFrame, columns: Sequence[str], aliases: Mapping[str, str]) -> DataFrame:
    """Projection with some columns under a new name (old name to new name)."""
    return df.select(*[F.col(c).alias(aliases.get(c, c)) for c in columns])


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def fill_nulls(df: DataFrame, values: Mapping[str, float | int | str]) -> DataFrame:
    """Per-column fill of NULL and, in floating-point columns, of NaN; names not in the table are ignored."""
    present = {c.lower() for c in df.columns}
    return df.fillna({c: v for c, v in values.items() if c.lower() in present})


def split_features_labels(
    df: DataFrame, features: Sequence[str], labels: Sequence[str], vector: str = "features"
) -> DataFrame:
    """One vector column of the features next to the labels.

    Labels are taken out of the feature list. Missing feature values stay as NaN inside the vector.
    """
    inputs = [f for f in features if f not in set(labels)]
    numbers = df.withColumns({f: F.col(f).cast("double") for f in inputs})
    assembled = VectorAssembler(inputCols=inputs, outputCol=vector, handleInvalid="keep").transform(numbers)
    return assembled.select(vector, *labels)


def scale_minmax(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Scale columns to ``(x - min) / (max - min)`` with bounds from ``fit_on`` (default: the table itself).

    A constant column gives 0; NULL stays NULL. The bounds are one scalar subquery, so no row is shuffled.
    """
    source = df if fit_on is None else fit_on
    cleaned = {c: null_nan(F.col(c).cast("double")) for c in columns}
    bounds = source.agg(
        F.struct(
            *[F.min(cleaned[c]).alias(f"lo_{c}") for c in columns],
            *[F.max(cleaned[c]).alias(f"hi_{c}") for c in columns],
        ).alias("bounds")
    )
    scaled = {}
    for c in columns:
        lo, hi = F.col(f"_bounds.lo_{c}"), F.col(f"_bounds.hi_{c}")
        ratio = F.coalesce(F.try_divide(cleaned[c] - lo, hi - lo), F.lit(0.0))
        scaled[c] = F.when(cleaned[c].isNotNull(), ratio)
    return df.withColumn("_bounds", bounds.scalar()).withColumns(scaled).drop("_bounds")
