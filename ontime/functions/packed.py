"""Positional decoding of comma-packed weather fields."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PackedField:
    """One output column: the ``position``-th part of ``source``, read as ``unit``."""

    name: str
    source: str
    position: int
    unit: str = "text"


# --- Fixed values: layout of the packed fields and the units of their parts. ---
WEATHER_LAYOUT = (
    PackedField("temp_f", "tmp", 0, "tenths_celsius"),
    PackedField("temp_qual", "tmp", 1),
    PackedField("wnd_deg", "wnd", 0),
    PackedField("wnd_1", "wnd", 1),
    PackedField("wnd_2", "wnd", 2),
    PackedField("wnd_mps", "wnd", 3, "tenths"),
    PackedField("wnd_4", "wnd", 4),
    PackedField("vis_m", "vis", 0, "number"),
    PackedField("vis_1", "vis", 1),
    PackedField("vis_2", "vis", 2),
    PackedField("vis_3", "vis", 3),
    PackedField("dew_pt_f", "dew", 0, "tenths_celsius"),
    PackedField("dew_1", "dew", 1),
    PackedField("slp_hpa", "slp", 0, "tenths"),
    PackedField("slp_1", "slp", 1),
    PackedField("precip_hr_dur", "aa1", 0, "number"),
    PackedField("precip_mm_intvl", "aa1", 1, "tenths"),
    PackedField("precip_cond", "aa1", 2),
    PackedField("precip_qual", "aa1", 3),
)

# Codes that stand for a missing value, by output column; pass them as ``missing_codes`` to drop them.
MISSING_CODES = {
    "temp_f": ("+9999", "9999"),
    "wnd_mps": ("9999",),
    "vis_m": ("999999",),
    "dew_pt_f": ("+9999", "9999"),
    "slp_hpa": ("99999",),
    "precip_hr_dur": ("99",),
    "precip_mm_intvl": ("9999",),
}
# --- End of fixed values. ---


def _in_unit(text: Column, unit: str) -> Column:
    if unit == "text":
        return text
    number = text.try_cast("double")
    if unit == "number":
        return number
    if unit == "tenths":
        return number / 10
    if unit == "tenths_celsius":
        return number * 9 / 50 + 32
    raise ValueError(f"unknown unit {unit!r}")


def packed_column(field: PackedField, missing_codes: Mapping[str, Collection[str]] | None = None) -> Column:
    part = F.get(F.split(F.col(field.source), ","), F.lit(field.position))
    codes = (missing_codes or {}).get(field.name)
    if codes:
        part = F.when(~part.isin(*codes), part)
    return _in_unit(part, field.unit).alias(field.name)


def decode_packed(
    df: DataFrame,
    layout: Sequence[PackedField] = WEATHER_LAYOUT,
    missing_codes: Mapping[str, Collection[str]] | None = None,
) -> DataFrame:
    """Add every decoded column, and the hourly rate ``precip_mm`` (NULL for a duration of zero hours).

    Parts that are absent or no number become NULL. Unused decoded columns cost nothing: they are pruned.
    """
    decoded = df.select("*", *[packed_column(field, missing_codes) for field in layout])
    names = {field.name for field in layout}
    if {"precip_mm_intvl", "precip_hr_dur"} <= names:
        decoded = decoded.withColumn("precip_mm", F.try_divide("precip_mm_intvl", "precip_hr_dur"))
    return decoded
