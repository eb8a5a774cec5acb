"""Calendar and time-of-day attribute columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import date_int, time_int


def calendar_columns(d: Column) -> list[Column]:
    """The 18 calendar attributes of a DATE column, in table order."""
    m = F.month(d)
    y = F.year(d)
    return [
        date_int(d).alias("date_int"),
        d.alias("calendar_date"),
        y.alias("calendar_year"),
        F.date_format(d, "MMMM").alias("calendar_month"),
        m.alias("month_of_year"),
        F.date_format(d, "EEEE").alias("calendar_day"),
        F.dayofweek(d).alias("day_of_week"),
        (F.weekday(d) + 1).alias("day_of_week_start_monday"),
        F.when(F.weekday(d) < 5, "Y").otherwise("N").alias("is_week_day"),
        F.dayofmonth(d).alias("day_of_month"),
        F.when(d == F.last_day(d), "Y").otherwise("N").alias("is_last_day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year_iso"),
        F.quarter(d).alias("quarter_of_year"),
        F.when(m >= 10, y + 1).otherwise(y).alias("fiscal_year_oct_to_sep"),
        ((m + 2) % 12 + 1).alias("fiscal_month_oct_to_sep"),
        F.when(m >= 7, y + 1).otherwise(y).alias("fiscal_year_jul_to_jun"),
        ((m + 5) % 12 + 1).alias("fiscal_month_jul_to_jun"),
    ]


def time_columns(ts: Column) -> list[Column]:
    """Time-of-day attributes; ``hour_24`` runs 1..24, so midnight is '24'."""
    return [
        time_int(ts).alias("time_int"),
        F.date_format(ts, "hh:mm a").alias("time"),
        F.date_format(ts, "hh").alias("hour"),
        F.date_format(ts, "HH:mm").alias("time_24"),
        F.date_format(ts, "kk").alias("hour_24"),
        F.date_format(ts, "a").alias("am_pm"),
    ]
