"""Calendar attributes for the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of


def date_key(c) -> Column:
    """Smart integer key YYYYMMDD."""
    return F.date_format(col_of(c), "yyyyMMdd").cast("int")


def calendar_columns(c) -> list[Column]:
    """The eight attribute columns of a day, in dimension order.

    Day of week counts Sunday as 0; month and day names are unpadded.
    """
    d = col_of(c)
    return [
        d.cast("date").alias("date_day"),
        F.year(d).alias("calendar_year"),
        F.quarter(d).alias("calendar_quarter"),
        F.month(d).alias("calendar_month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
    ]
