"""Month arithmetic. A month is the DATE of its first day; month_index is year*12+month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_floor(day: Column) -> Column:
    return F.trunc(day, "MM").cast("date")


def month_shift(day: Column, months: int | Column) -> Column:
    return F.add_months(month_floor(day), months)


def month_index(day: Column) -> Column:
    return (F.year(day) * 12 + F.month(day)).cast("int")


def month_sequence(first: dt.date, n_months: int) -> Column:
    """Array of the months [first, first + n_months)."""
    start = F.lit(first)
    return F.sequence(start, F.add_months(start, n_months - 1), F.expr("interval 1 month"))


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day)).cast("int")


def tenure_months(as_of: Column, since: Column) -> Column:
    return (month_index(as_of) - month_index(since)).cast("int")


def plus_years_leap(day: Column, years: int) -> Column:
    """Same day `years` later; 29 February becomes 1 March where the target year has none."""
    target = F.add_months(day, 12 * years)
    lost_leap_day = (F.dayofmonth(day) == 29) & (F.month(day) == 2) & (F.dayofmonth(target) == 28)
    return F.when(lost_leap_day, F.date_add(target, 1)).otherwise(target)


def maturity_date(disbursed: Column, tenure: Column) -> Column:
    return F.add_months(month_floor(disbursed), tenure.cast("int"))
