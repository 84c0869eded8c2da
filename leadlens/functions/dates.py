"""Date and time expressions used by the funnel profiles."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Ages are measured in 365-day years; the quarter of a month
# is 1 for months 1-3, 2 for 4-6, 3 for 7-9 and 4 otherwise.
DAYS_PER_YEAR = 365.0


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_of(value: str | _dt.date | _dt.datetime | None = None) -> Column:
    """SC20: the reference's ``'today'`` literal as an explicit parameter.

    ``None`` means midnight of the current date; a fixed value keeps a plan
    reproducible.
    """
    if value is None:
        return F.current_date().cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def to_day(x: ColumnOrName) -> Column:
    """SC15: ``cast(x as date)``."""
    return F.to_date(_c(x))


def month_end(x: ColumnOrName) -> Column:
    """SC16: ``date_trunc('month', x) + interval '1 month - 1 day'`` as a date."""
    return F.last_day(_c(x))


def quarter_of(x: ColumnOrName) -> Column:
    """SC17/FLT13: quarter number from the month (CASE on month BETWEEN ranges)."""
    return F.quarter(_c(x))


def age_years(later: ColumnOrName, earlier: ColumnOrName, scale: float = 1.0) -> Column:
    """SC18: whole days between two dates divided by 365.0.

    ``scale`` multiplies the day count before the division (used by the
    synthetic query to stretch short spans).
    """
    days = F.datediff(to_day(later), to_day(earlier))
    if scale != 1.0:
        days = days * F.lit(scale)
    return days / F.lit(DAYS_PER_YEAR)


def shift(ts: ColumnOrName, amount: str) -> Column:
    """SC19: ``ts + INTERVAL amount`` where amount reads like '1 hour', '-60 days'."""
    n, unit = amount.split()
    return _c(ts) + F.expr(f"INTERVAL '{int(n)}' {unit.rstrip('s').upper()}")


def strictly_within(x: ColumnOrName, anchor: ColumnOrName, low: str, high: str) -> Column:
    """FLT12: ``anchor + low < x < anchor + high`` (both ends open)."""
    return (_c(x) > shift(anchor, low)) & (_c(x) < shift(anchor, high))


def seconds_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """AG9 input: ``later - earlier`` in seconds (microsecond exact), as double."""
    return F.timestamp_diff("MICROSECOND", _c(earlier), _c(later)) / F.lit(1_000_000.0)
