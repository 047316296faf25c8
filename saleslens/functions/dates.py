"""Calendar arithmetic (F7-F12). ``as_of`` replaces the reference's 'today'."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the planning growth factor applied to the prior-year run rate.
GROWTH_FACTOR = "1.3012"


def as_date(d) -> Column:
    if isinstance(d, Column):
        return d.cast("date")
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.isoformat()[:10]
    return F.lit(d).cast("date")


def shift_date(d, anchor, as_of) -> Column:
    """move a date so that ``anchor`` lands on ``as_of``; day distances are kept. NULL stays NULL."""
    c = F.col(d) if isinstance(d, str) else d
    return F.date_add(as_date(as_of), F.datediff(c.cast("date"), as_date(anchor)))


def to_day(c) -> Column:
    """F8: datetime -> date."""
    return (F.col(c) if isinstance(c, str) else c).cast("date")


def year_start(as_of, years_back: int = 0) -> Column:
    a = as_date(as_of)
    return F.make_date(F.year(a) - F.lit(years_back), F.lit(1), F.lit(1))


def days_in_prior_year(as_of) -> Column:
    """days from 1 Jan of the prior year to 1 Jan of this year (365 or 366)."""
    return F.datediff(year_start(as_of, 0), year_start(as_of, 1))


def elapsed_days_inclusive(as_of) -> Column:
    """days from 1 Jan through ``as_of``, both included (1 on 1 Jan)."""
    return F.datediff(as_date(as_of), year_start(as_of, 0)) + F.lit(1)


def day_after(as_of) -> Column:
    return F.date_add(as_date(as_of), 1)


def quarter_start(c) -> Column:
    """first day of the quarter."""
    return F.trunc(F.col(c) if isinstance(c, str) else c, "quarter")


def month_start(c) -> Column:
    """first day of the month."""
    return F.trunc(F.col(c) if isinstance(c, str) else c, "month")
