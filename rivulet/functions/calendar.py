"""Date arithmetic used by the calendar-grained tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rivulet.functions.clean import col


def month_start(d: Column | str) -> Column:
    return F.trunc(col(d), "month")


def days_in_month(d: Column | str) -> Column:
    return F.dayofmonth(F.last_day(col(d)))


def epoch_seconds(d: Column | str) -> Column:
    return F.unix_date(col(d)).cast("bigint") * 86400


def load_time(load_id: Column | str) -> Column:
    """Load identifiers are epoch seconds written as text."""
    return F.timestamp_seconds(col(load_id).cast("double"))


def shift(d: Column | str, days: int = 0, months: int = 0, years: int = 0) -> Column:
    moved = col(d)
    if months or years:
        moved = F.add_months(moved, months + 12 * years)
    return F.date_add(moved, days) if days else moved


def date_parts(d: Column | str) -> dict[str, Column]:
    """ISO week and ISO weekday (Monday = 1); weekend is Saturday and Sunday."""
    d = col(d)
    iso_day = F.weekday(d) + 1
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "week": F.weekofyear(d),
        "day_of_year": F.dayofyear(d),
        "iso_day_of_week": iso_day,
        "is_weekend": iso_day >= 6,
    }
