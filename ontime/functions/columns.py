"""Column builders: every function takes columns (or their names) and returns a Column."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def null_nan(value: ColumnLike) -> Column:
    """NaN becomes NULL: Spark aggregates skip NULL but propagate NaN."""
    return F.nanvl(as_column(value), F.lit(None).cast("double"))


def _clock_digits(hhmm: ColumnLike) -> Column:
    return F.lpad(as_column(hhmm).cast("string"), 4, "0")


def hhmm_timestamp(day: ColumnLike, hhmm: ColumnLike) -> Column:
    """Timestamp of a date and an HHMM number; NULL when the digits are no time of day."""
    digits = _clock_digits(hhmm)
    text = F.concat(
        as_column(day).cast("date").cast("string"), F.lit(" "), F.substring(digits, 1, 2), F.lit(":"),
        F.substring(digits, 3, 2),
    )
    return text.try_cast("timestamp")


def hhmm_hour(hhmm: ColumnLike, mode: str = "round") -> Column:
    """Hour of an HHMM number: ``round`` goes to the nearest hundred (1250 is 13), ``floor`` drops the minutes."""
    hundreds = as_column(hhmm).cast("double") / 100
    if mode == "round":
        return F.round(hundreds).cast("int")
    if mode == "floor":
        return F.floor(hundreds).cast("int")
    raise ValueError(f"mode {mode!r} is neither 'round' nor 'floor'")


def block_hour(block: ColumnLike) -> Column:
    """Leading hour of an ``HHMM-HHMM`` block."""
    return F.substring(as_column(block), 1, 2).try_cast("int")


def route(origin: ColumnLike, dest: ColumnLike) -> Column:
    return F.concat(as_column(origin), F.lit("-"), as_column(dest))


def carrier_number(carrier: ColumnLike, number: ColumnLike) -> Column:
    return F.concat(as_column(carrier), F.lit("_"), as_column(number).cast("string"))


def trip_id(path: ColumnLike, day: ColumnLike) -> Column:
    return F.concat(as_column(path), F.lit("_"), as_column(day).cast("date").cast("string"))


def composite_key(hour: ColumnLike, code: ColumnLike) -> Column:
    """Readable ``hour-code`` key; joins use the two typed columns instead."""
    return F.concat(as_column(hour).cast("string"), F.lit("-"), as_column(code))


def city_of(name: ColumnLike) -> Column:
    """Text before the first comma of ``City, ST``."""
    return F.get(F.split(as_column(name), ","), F.lit(0))


def elapsed_hours(minutes: ColumnLike) -> Column:
    return F.round(as_column(minutes).cast("double") / 60).cast("int")


def delay15(flag: ColumnLike) -> Column:
    """0/1 flag as an integer whatever its source type: number, ``'1'`` or ``'1.0'``."""
    return as_column(flag).try_cast("double").try_cast("int")


def hour_of(ts: ColumnLike) -> Column:
    return F.date_trunc("hour", as_column(ts)).cast("timestamp")


def roll_overnight(
    arr: ColumnLike,
    dep: ColumnLike,
    mode: str = "keep_hour",
    exact: tuple[ColumnLike, ColumnLike] | None = None,
) -> Column:
    """Move an arrival that lies before its departure to the next day.

    ``keep_hour`` adds one day; ``midnight`` goes to the start of the next day. The hour columns are compared with
    ``<=``; with ``exact=(arr_ts, dep_ts)`` the full timestamps decide, so that a trip within one hour stays.
    """
    arr_hour = as_column(arr)
    if mode == "keep_hour":
        rolled = arr_hour + F.expr("INTERVAL 1 DAY")
    elif mode == "midnight":
        rolled = F.date_add(arr_hour, 1).cast("timestamp")
    else:
        raise ValueError(f"mode {mode!r} is neither 'keep_hour' nor 'midnight'")
    if exact is None:
        late = arr_hour <= as_column(dep)
    else:
        late = as_column(exact[0]) <= as_column(exact[1])
    return F.when(late, rolled).otherwise(arr_hour)


def station_code(call_sign: ColumnLike) -> Column:
    """Three-letter code of a call sign such as ``'KJFK '``, padded or not."""
    padded = F.rpad(F.trim(as_column(call_sign)), 5, " ")
    return F.substring(padded, -4, 3)


def delay_level(minutes: ColumnLike) -> Column:
    """0 up to 5 minutes and for missing values, 1 up to 45, 2 above."""
    value = null_nan(as_column(minutes).cast("double"))
    return F.when(value > 45, 2).when(value > 5, 1).otherwise(0)


def clock(as_of: ColumnLike | datetime) -> Column:
    """The board's point in time: a timestamp literal or a column."""
    return F.lit(as_of).cast("timestamp") if isinstance(as_of, datetime) else as_column(as_of)


def trip_status(dep: ColumnLike, arr: ColumnLike, as_of: ColumnLike | datetime, rule: str = "reference") -> Column:
    """Status of a scheduled trip at a point in time.

    ``reference``: an arrival at or after now is ``Landed``, both times before now are ``En Route``.
    ``clock``: before departure ``Scheduled``, in between ``En Route``, from arrival on ``Landed``.
    """
    now, leaves, lands = clock(as_of), as_column(dep), as_column(arr)
    if rule == "reference":
        return (
            F.when(lands >= now, "Landed")
            .when((leaves < now) & (lands < now), "En Route")
            .when(leaves > now, "Scheduled")
        )
    if rule == "clock":
        return F.when(leaves > now, "Scheduled").when(lands > now, "En Route").when(lands <= now, "Landed")
    raise ValueError(f"rule {rule!r} is neither 'reference' nor 'clock'")


def estimated_clock(base: ColumnLike, minutes: ColumnLike, rounding: str | None = None) -> Column:
    """Scheduled time plus predicted minutes as ``HH:mm``; ``rounding='half_even'`` takes whole minutes first."""
    value = as_column(minutes).cast("double")
    if rounding == "half_even":
        value = F.bround(value)
    elif rounding is not None:
        raise ValueError(f"rounding {rounding!r} is neither None nor 'half_even'")
    micros = F.unix_micros(as_column(base).cast("timestamp")) + F.round(value * 60_000_000).cast("long")
    return F.date_format(F.timestamp_micros(micros), "HH:mm")


def minute_text(ts: ColumnLike) -> Column:
    return F.date_format(as_column(ts), "yyyy-MM-dd HH:mm")


def at_time_of_day(day: ColumnLike, ts: ColumnLike | datetime) -> Column:
    """The given date combined with the time of day of ``ts``."""
    moment = clock(ts)
    since_midnight = F.unix_micros(moment) - F.unix_micros(F.date_trunc("day", moment))
    return F.timestamp_micros(F.unix_micros(as_column(day).cast("date").cast("timestamp")) + since_midnight)


def lookup(code: ColumnLike, names: dict[str, str], keep_unknown: bool = False) -> Column:
    """Display name of a code from a small fixed table, as a map literal: no join, no shuffle."""
    key = as_column(code)
    pairs = [F.lit(item) for pair in names.items() for item in pair]
    name = F.try_element_at(F.create_map(*pairs), key)
    return F.coalesce(name, key) if keep_unknown else name


def run_id(*params: ColumnLike) -> Column:
    """Ten hexadecimal digits that depend only on the parameter values."""
    parts = [F.coalesce(as_column(p).cast("string"), F.lit("")) for p in params]
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, 10)
