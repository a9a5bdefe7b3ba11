"""Parameters of one run: airport, training dates, inference date."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass
from datetime import date, timedelta

from ontime.schema import AIRPORT_CODES


@dataclass(frozen=True)
class RunParams:
    airport: str
    train_start: date
    train_end: date
    inference: date


def _as_date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def run_params(
    airport: str,
    train_start: date | str,
    train_end: date | str,
    inference: date | str | None = None,
    airports: Collection[str] | None = AIRPORT_CODES,
) -> RunParams:
    """Check and complete the parameters; the inference date defaults to the day after training ends.

    ``airports`` is the accepted domain; ``None`` accepts any code.
    """
    if airports is not None and airport not in airports:
        raise ValueError(f"unknown airport {airport!r}, expected one of {sorted(airports)}")
    start, end = _as_date(train_start), _as_date(train_end)
    if start > end:
        raise ValueError(f"training starts {start} after it ends {end}")
    day = end + timedelta(days=1) if inference is None else _as_date(inference)
    return RunParams(airport, start, end, day)
