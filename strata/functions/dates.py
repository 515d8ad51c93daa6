"""Calendar attributes of a date, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(d: Column) -> list[Column]:
    """The 18 calendar-dimension columns for a ``date``/timestamp column ``d``.

    ``day_of_week`` is 0 = Monday .. 6 = Sunday and ``week_of_year`` is the ISO
    week; month and day names are the full English names.
    """
    day = F.to_date(d)
    month_start = F.trunc(day, "MM")
    quarter_start = F.trunc(day, "quarter")
    year_start = F.trunc(day, "year")
    dow = F.weekday(day)
    return [
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day.cast("timestamp_ntz").alias("date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_name_short"),
        F.dayofmonth(day).alias("day"),
        dow.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        dow.isin(5, 6).alias("is_weekend"),
        (day == month_start).alias("is_month_start"),
        (day == F.last_day(day)).alias("is_month_end"),
        (day == quarter_start).alias("is_quarter_start"),
        (day == F.last_day(F.add_months(quarter_start, 2))).alias("is_quarter_end"),
        (day == year_start).alias("is_year_start"),
        ((F.month(day) == 12) & (F.dayofmonth(day) == 31)).alias("is_year_end"),
    ]
