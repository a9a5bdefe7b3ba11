"""Row filters; all of them are plain predicates that reach the scan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType

from ontime.functions.columns import ColumnLike, as_column

FLOAT64_MAX = 1.7976931348623157e308


def filter_endpoint(df: DataFrame, code: str, origin: str = "origin", dest: str = "dest") -> DataFrame:
    return df.where((F.col(dest) == code) | (F.col(origin) == code))


def _day_bound(df: DataFrame, column: str, value: date | str) -> Column:
    """Literal in the column's own type, so that the comparison is pushed down without a cast on the column."""
    kind = df.schema[_field(df, column)].dataType
    text = value.isoformat() if isinstance(value, date) else value
    day = F.lit(date.fromisoformat(text[:10]))
    if isinstance(kind, StringType):
        return F.lit(text)
    return day if isinstance(kind, DateType) else day.cast(kind)


def _field(df: DataFrame, column: str) -> str:
    return next(f.name for f in df.schema.fields if f.name.lower() == column.lower())


def filter_dates(
    df: DataFrame,
    lo: date | str | None = None,
    hi: date | str | None = None,
    closed: str = "both",
    column: str = "fl_date",
) -> DataFrame:
    """Rows from day ``lo`` to day ``hi``; ``closed`` is ``both``, ``left``, ``right`` or ``neither``.

    On a timestamp column the bounds still mean whole days: an included last day runs to its end.
    """
    if closed not in ("both", "left", "right", "neither"):
        raise ValueError(f"unknown interval {closed!r}")
    value, kind = F.col(column), df.schema[_field(df, column)].dataType
    whole_days = not isinstance(kind, (DateType, StringType))
    one_day = F.expr("INTERVAL 1 DAY")
    out = df
    if lo is not None:
        bound = _day_bound(df, column, lo)
        if closed in ("both", "left"):
            out = out.where(value >= bound)
        else:
            out = out.where(value >= bound + one_day if whole_days else value > bound)
    if hi is not None:
        bound = _day_bound(df, column, hi)
        if closed in ("both", "right"):
            out = out.where(value < bound + one_day if whole_days else value <= bound)
        else:
            out = out.where(value < bound)
    return out


def filter_completed(df: DataFrame, cancelled: str = "cancelled", diverted: str = "diverted") -> DataFrame:
    """Neither cancelled nor diverted; rows with an unknown flag drop out."""
    return df.where((F.col(cancelled) != 1) & (F.col(diverted) != 1))


def filter_not_cancelled(df: DataFrame, cancelled: str = "cancelled") -> DataFrame:
    return df.where(F.col(cancelled) == 0)


def filter_not_null(df: DataFrame, column: str = "dest_state_abr") -> DataFrame:
    return df.where(F.col(column).isNotNull())


def filter_like(df: DataFrame, column: ColumnLike, pattern: str) -> DataFrame:
    return df.where(as_column(column).like(pattern))


def filter_report(df: DataFrame, report_type: str = "FM-15", name_pattern: str = "% AIRPORT%") -> DataFrame:
    """Regular hourly reports of airport stations."""
    return df.where((F.col("report_type") == report_type) & F.col("name").like(name_pattern))


def filter_edges(edges: DataFrame, end: str, code: str, delay: str = "delay") -> DataFrame:
    """Delayed edges that start (``end='src'``) or finish (``'dst'``) at a vertex."""
    if end not in ("src", "dst"):
        raise ValueError(f"end {end!r} is neither 'src' nor 'dst'")
    return edges.where((F.col(end) == code) & (F.col(delay) > 0))


def latest_partition(df: DataFrame, column: str = "fl_date", dates: DataFrame | None = None) -> DataFrame:
    """Rows of the latest date: the maximum is a scalar subquery, so the rows themselves are never shuffled.

    ``dates`` may hold the column's values already, such as the partitions that the catalog lists (``partition_values``).
    """
    latest = (df if dates is None else dates).agg(F.max(column).alias("latest")).scalar()
    return df.where(F.col(column) == latest)


def drop_any_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without any NULL or NaN."""
    return df.dropna(how="any", subset=list(columns) if columns else None)


def flag_out_of_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value that is NaN, infinite or at the limit of a double."""
    wide = [F.col(c).cast("double") for c in columns]
    return df.where(reduce(or_, [F.isnan(c) | (F.abs(c) >= FLOAT64_MAX) for c in wide]))


def numeric_columns(df: DataFrame, kinds: tuple[type, ...] = (DoubleType,)) -> list[str]:
    """Names of the double columns, or of the columns of other types."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]

