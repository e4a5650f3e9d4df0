"""Calendar buckets encoded as integers, and date predicates that reach the scan.

A monthly period is ``year * 100 + month``; a weekly one ``year * 100 + ISO week``.
"""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_period(day: Column) -> Column:
    """YYYYMM as INT."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def week_period(day: Column, style: str = "calendar") -> Column:
    """YYYYWW as INT.

    ``calendar`` pairs the calendar year with the ISO week number, so the days around
    New Year land in week 1, 52 or 53 of the year they are written in (2019-12-30 gives
    201901). ``iso`` uses the year the ISO week belongs to.
    """
    if style == "calendar":
        year = F.year(day)
    elif style == "iso":
        year = F.extract(F.lit("YEAROFWEEK"), day)
    else:
        raise ValueError(f"week style must be 'calendar' or 'iso', not {style!r}")
    return (year * 100 + F.weekofyear(day)).cast("int")


def period_start(period: Column) -> Column:
    """First day of a YYYYMM period."""
    return F.make_date((period / 100).cast("int"), period % 100, F.lit(1))


def on_or_after_year(day: Column, year: int) -> Column:
    """``year(day) >= year`` as a plain range test, which file statistics can answer."""
    return day >= F.lit(date(year, 1, 1))


def on_or_before(moment: Column, day: date) -> Column:
    """True up to and including the whole of ``day``, for DATE and TIMESTAMP alike."""
    return moment < F.lit(date.fromordinal(day.toordinal() + 1))


def shift_months(day: date, months: int) -> date:
    """First day of the month ``months`` away from the month of ``day``."""
    index = day.year * 12 + day.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


def first_of_month(day: date) -> date:
    """First day of the month of ``day``."""
    return shift_months(day, 0)
